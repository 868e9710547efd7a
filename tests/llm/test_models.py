"""Tokenising, language-model scoring and HTML extraction."""

import html
import re
from dataclasses import replace

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from kilnwork.llm import extraction, pieces
from kilnwork.llm import pseudo_likelihood as pl

MODEL = pieces.read_model("/opt/tokenizers/piece_bpe_32k.model")
ODD = [
    None, "", " ", "  ", " a", "a  b   c    d", "x     y", " " * 17 + "q" + " " * 23, "\n\n  \t😀 日本語 한국", "<s> </s> <unk> <0x41>",
    "a\x00b", "ﬁ №", "word " * 5000, "z" * 20000, "word " * 5000,
]


@pytest.fixture(scope="module")
def library():
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_proto=MODEL)


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet=st.one_of(st.characters(exclude_categories=("Cs",)), st.sampled_from(" ab▁\n")), max_size=60))
def test_parity_with_the_library(text):
    import sentencepiece

    other = sentencepiece.SentencePieceProcessor(model_proto=MODEL)
    own = pieces.codec(MODEL)
    (ids,) = own.encode([text])
    assert ids.tolist() == other.encode(text)
    if "▁" not in text:
        assert own.decode(ids) == text


def test_every_given_document_has_parity_and_round_trips(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    encoded = pieces.encode(docs, MODEL, keep=["doc_id", "text"], parity_every=1)
    rows = encoded.collect()
    assert len(rows) == docs.count() and all(r["round_trip"] and r["parity"] for r in rows)
    assert all(r["n_tokens"] == len(r["ids"]) and r["n_bytes"] == len(r["text"].encode()) for r in rows)
    back = {r["doc_id"]: r["text"] for r in pieces.decode(encoded, MODEL).collect()}
    assert back == {r["doc_id"]: r["text"] for r in rows}


def test_parity_is_checked_for_every_text_by_default(spark):
    docs = spark.createDataFrame([(i, f"text {i % 50}") for i in range(100)], "doc_id long, text string")
    assert pieces.encode(docs, MODEL).filter("parity").count() == 100


def test_odd_rows_encode(spark, library):
    df = spark.createDataFrame([(i, t, "e") for i, t in enumerate(ODD)] + [(None, "x", "e")], "doc_id long, text string, ids string")
    got = pieces.encode(df, MODEL, parity_every=1).collect()
    assert len(got) == len(ODD) + 1
    for r in got:
        text = "x" if r["doc_id"] is None else ODD[r["doc_id"]] or ""
        assert r["ids"] == library.encode(text) and r["round_trip"] and r["parity"]
    assert pieces.encode(df.limit(0), MODEL).count() == 0
    assert pieces.encode(df, MODEL, parity_every=0).filter("parity is not null").count() == 0


def test_marked_spaces_are_told(spark):
    got = pieces.encode(spark.createDataFrame([(1, "a▁b")], "doc_id long, text string"), MODEL, parity_every=1).first()
    assert got["parity"] and not got["round_trip"]


def unigram_model():
    def field(number, data):
        return bytes([number << 3 | 2, len(data)]) + data

    import struct

    def piece(name, score, kind):
        return field(1, field(1, name.encode()) + b"\x15" + struct.pack("<f", score) + bytes([3 << 3, kind]))

    rows = [("<unk>", 0, 2), ("<s>", 0, 3), ("</s>", 0, 3), ("▁", -3, 1), ("a", -2, 1), ("b", -2.5, 1), ("ab", -3, 1), ("▁ab", -4, 1), ("ba", -4.2, 1)]
    return b"".join(piece(*r) for r in rows) + field(2, bytes([3 << 3, 1])) + field(3, b"\x18\x01\x20\x00")


def test_unigram_models(spark):
    import sentencepiece

    data = unigram_model()
    other, own = sentencepiece.SentencePieceProcessor(model_proto=data), pieces.codec(data)
    for text in ("ab", "abba", "ba ab a", "aab bb", ""):
        assert own.encode([text])[0].tolist() == other.encode(text), text


def test_gradients_of_the_window_network():
    random = np.random.default_rng(0)
    vocabulary = pl.Vocabulary(np.empty(0, np.uint64), np.empty(0, np.int64), random.random(pl.PAD) * 50, 1)
    net = pl.start(vocabulary)
    ids = random.integers(0, pl.PAD, 40)
    around = pl.contexts(ids, np.repeat([0, 1], 20))
    assert (around[0, :2] == pl.PAD).all() and around[0, 2] == ids[1] and around[20, 1] == pl.PAD and around[19, 2] == pl.PAD
    logs = pl.log_probabilities(net, ids, around)
    assert (logs < 0).all()
    every = np.arange(pl.PAD)
    assert abs(np.exp(pl.log_probabilities(net, every, np.repeat(around[:1], pl.PAD, 0))).sum() - 1) < 1e-3
    before = logs.mean()
    for _ in range(60):
        pl.train(net, iter([(ids, around)]))
    assert pl.log_probabilities(net, ids, around).mean() > before + 1


def test_both_sides_tell_a_word(spark):
    random = np.random.default_rng(1)
    pairs = [("red", "apple"), ("blue", "sky"), ("old", "tree"), ("new", "road")]
    texts = []
    for _ in range(600):
        parts = []
        for _ in range(30):
            a, b = pairs[random.integers(4)]
            parts += [a, f"m{pairs.index((a, b))}", b]
        texts.append(" ".join(parts))
    held, shuffled = texts[:50], [" ".join(random.permutation(t.split())) for t in texts[:50]]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts[50:])], "doc_id long, text string").repartition(2)
    vocabulary = pl.fit_vocabulary(docs)
    assert vocabulary.counts.sum() == 550 * 90 and len(vocabulary.hashes) == 12
    net = pl.fit(docs, vocabulary, share=1.0, rounds=3)
    unigram = pl.start(vocabulary)

    def mean(texts, net):
        df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
        rows = pl.score(df, vocabulary, net).collect()
        return sum(r["log_likelihood"] for r in rows) / sum(r["n_words"] for r in rows)

    assert mean(held, net) > mean(held, unigram) + 0.5
    assert mean(held, net) > mean(shuffled, net) + 0.5


def test_unknown_words_score_by_their_own_counts(spark):
    # 4,095 words seen 60 times each fill the list; of the others one is seen 50 times, one 10 times, one once.
    texts = [" ".join(f"w{i}" for i in range(pl.PAD - 1))] * 60 + ["often"] * 50 + ["seldom"] * 10 + ["once"]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(4)
    vocabulary = pl.fit_vocabulary(docs)
    assert vocabulary.counts[pl.UNKNOWN] == 61 and vocabulary.others == 3
    probe = spark.createDataFrame([("often",), ("seldom",), ("once",), ("never",), ("often once",)], "text string")
    net = pl.start(vocabulary)
    rows = {r["text"]: r["log_likelihood"] for r in pl.score(probe, vocabulary, net, keep=["text"]).collect()}
    assert rows["often"] - rows["once"] == pytest.approx(np.log(50))
    assert rows["seldom"] - rows["once"] == pytest.approx(np.log(10))
    assert rows["never"] == pytest.approx(rows["once"])
    alone = pl.log_probabilities(net, np.array([pl.UNKNOWN]), np.full((1, 2 * pl.SIDE), pl.PAD))[0]
    assert sum(np.exp(rows[w]) for w in ("often", "seldom", "once")) == pytest.approx(np.exp(alone))
    # As context, unknown words differ too.
    hashes = np.array([1, 2], np.uint64)
    assert len(set(pl.context_ids(np.zeros(2, np.int64), hashes))) == 2 and (pl.context_ids(np.array([5, 6]), hashes) == [5, 6]).all()


def test_training_sees_every_row_once(spark, monkeypatch):
    # A text that a third of the rows share, and others.
    texts = ["copy of a text"] * 100 + [f"text number {i}" for i in range(200)]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(3)
    seen, frame = [], type(docs)
    collect = frame.collect
    monkeypatch.setattr(frame, "collect", lambda self: seen.append(collect(self)) or seen[-1])
    vocabulary = pl.fit_vocabulary(docs)
    seen.clear()
    pl.fit(docs, vocabulary)
    words = [r["words"] for got in seen for r in got]
    assert sum(words) == sum(len(t.split()) for t in texts)
    assert max(words) < 0.5 * sum(words)  # copies do not go as one
    for share, rounds in ((0.3, 4), (1.0, 3)):
        n = [spark.range(1000).filter(pl._in_round(F.col("id") * F.lit(pl._DRAWS // 1000), i, share)).count() for i in range(rounds)]
        assert all(abs(x - 1000 * share) <= 1 for x in n)


def test_scores_of_odd_rows(spark):
    df = spark.createDataFrame([(i, t, "e") for i, t in enumerate(ODD)] + [(None, "x", "e")], "doc_id long, text string, n_words string")
    vocabulary = pl.fit_vocabulary(df)
    got = {r["doc_id"]: r for r in pl.score(df, vocabulary, pl.fit(df, vocabulary, share=1.0, rounds=1)).collect()}
    assert len(got) == len(ODD) + 1
    assert got[0]["n_words"] == 0 and got[0]["log_likelihood"] == 0 and got[0]["perplexity"] is None
    assert got[12]["log_likelihood"] == pytest.approx(got[14]["log_likelihood"]) and got[13]["n_words"] == 1
    empty = df.limit(0)
    nothing = pl.fit_vocabulary(empty)
    assert pl.score(empty, nothing, pl.fit(empty, nothing)).count() == 0


def article_by_hand(page):
    """For the given pages: their article has only headings, paragraphs, bold text and line breaks."""
    found = re.search(r"<article>(.*?)(</article>|\Z)", page, re.S)
    body = re.sub(r"<[a-z/!][^>]*\Z", "", found[1] if found else "")
    body = re.sub(r"</?b>", "", re.sub(r"<br>", " ", body))
    blocks = (" ".join(html.unescape(b).split()) for b in re.split(r"</?(?:p|h1)>", body))
    return "\n\n".join(b for b in blocks if b)


def test_given_pages(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    want = {r["page_id"]: article_by_hand(r["html"]) for r in pages.collect()}
    rows = extraction.extract(pages).collect()
    assert {r["page_id"]: r["text"] for r in rows} == want
    assert all(r["n_chars"] == len(r["text"]) for r in rows)


@pytest.mark.parametrize(
    "page, text",
    [
        (None, ""), ("", ""), ("plain < text & more", "plain < text & more"), ("<p>a<p>b", "a\n\nb"),
        ("<nav>n</nav><main><h1>T</h1>x&nbsp; y<br>z</main><footer>f</footer>", "T\n\nx y z"),
        ("<article><header><h1>T</h1></header><p>a</p><aside>s</aside></article><article>b</article>", "T\n\na"),
        ("<body><script>if (a<b) '</p>'</script><style>p{}</style><p>&lt;ok&gt; &#233;&eacute;</p><p", "<ok> éé"),
        ('<div class="cookie-notice">c</div><div id="comments">d</div><p hidden>h</p><p>kept</p>', "kept"),
        ("<ul><li>a<li>b</ul><table><tr><td>c<td>d</table>", "a\n\nb\n\nc\n\nd"),
        ("<p>a <b>b<p>c</b> d</p>e", "a b\n\nc d\n\ne"), ("<!-- x --><p>a<!-- <p>b --></p>", "a"), ("<article></article><p>out", ""),
        ("<p title='a>b'>q</p><form>f</form><iframe>i</iframe>", "q"), ("<div>" * 3000 + "deep" + "</div>" * 3000, "deep"),
    ],
)
def test_pages_by_hand(page, text):
    assert extraction.main_text(page) == text


def test_templates_of_a_host_go_and_copies_of_an_article_stay(spark):
    def page(i, banner, body):
        return f"<html><body><div><p>{banner}</p></div><div><p>{body}</p></div></body></html>"

    rows = [(i, "https://a.example/x", page(i, "Welcome to our site", f"own text {i}"), "t") for i in range(30)]
    rows += [(100 + i, "https://b.example/x", page(i, "Welcome to our site" if i == 0 else f"banner {i}", f"other {i}"), "t") for i in range(30)]
    rows += [(200 + i, "https://c.example/x", "<article><p>the same article</p></article>", "t") for i in range(30)]
    rows += [(300, None, None, "t"), (None, "odd", "<p>x</p>", "t"), (1, "https://a.example/x", rows[1][2], "t")]
    got = extraction.extract(spark.createDataFrame(rows, "page_id long, url string, html string, text string")).collect()
    assert len(got) == len(rows)
    texts = {r["page_id"]: r["text"] for r in got}
    assert all(texts[i] == f"own text {i}" for i in range(30))
    assert texts[100] == "Welcome to our site\n\nother 0"
    assert all(texts[200 + i] == "the same article" for i in range(30))
    assert texts[300] == "" and texts[None] == "x"
    assert extraction.extract(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_copies_of_a_page_keep_their_text_and_templates_of_large_hosts_go(spark):
    def rows_of(host, first, bodies):
        return [(first + i, f"https://{host}/{i}", f"<html><body>{b}</body></html>") for i, b in enumerate(bodies)]

    rows = rows_of("a.example", 0, ["<article><div class=body><p>same</p></div></article>"] * 8)
    rows += rows_of("b.example", 100, ["<div>top</div><div class=content><p>same</p></div>"] * 8)
    # A block on 6 pages of 300 is as much a template as on 6 of 6; within copies it goes too.
    box = "<div><p>Ask our experts</p></div>"
    rows += rows_of("c.example", 1000, [f"<article><p>text {i}</p>{box if i < 6 else ''}</article>" for i in range(300)])
    rows += rows_of("c.example", 2000, [f"<article><div><p>copied</p></div>{box}</article>"] * 8)
    got = extraction.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    texts = {r["page_id"]: r["text"] for r in got}
    assert {texts[i] for i in range(8)} == {"same"}
    assert {texts[100 + i] for i in range(8)} == {"top\n\nsame"}
    assert all(texts[1000 + i] == f"text {i}" for i in range(300))
    assert {texts[2000 + i] for i in range(8)} == {"copied"}


@pytest.mark.parametrize(
    "page, text",
    [
        ("<div class='content with-sidebar'><article><p>a</p></article><div class=sidebar>s</div></div>", "a"),
        ("<div id='page' class='has-comments'><p>a</p></div>", "a"),
        ("<div class='page share-bar-left'><article><p>a</p></article></div><p>o", "a"),
        ("<div class='layout sidebar-right'><p>the text of the page</p></div><div class='sidebar-right'>links</div>", "the text of the page"),
        ("<article><section id='related-work'><h2 id='search-algorithms'>S</h2><p>a</p></section><h2 id=notice>N</h2><p>b</p></article>", "S\n\na\n\nN\n\nb"),
        ("<article><p>a</p><figure><pre>code</pre><figcaption>c</figcaption></figure><p>If <math><mi>x</mi></math></p></article>", "a\n\ncode\n\nc\n\nIf x"),
        ("<article><p>a</p></article><div id=comments><article><p>a long comment</p></article></div>", "a"),
        ("<article><p>a</p><div class='share-buttons'>s</div><div class=related><h3>More</h3></div><p>b c</p></article>", "a\n\nb c"),
        ("<article class='post has-comments'><p>a</p></article>", "a"),
    ],
)
def test_words_of_attributes_delete_only_what_is_beside_the_text(page, text):
    assert extraction.main_text(page) == text


@pytest.mark.parametrize(
    "page, text",
    [
        ("<article><p title=it's>Alpha beta.</p><p>It's fine.</p><p>End.</p></article>", "Alpha beta.\n\nIt's fine.\n\nEnd."),
        ("<article><p title = \"a>b\" class='c>d' id=x/y>One.</p><p a=b\"c>Two.</p><p q'=1>Three.</p></article>", "One.\n\nTwo.\n\nThree."),
        ("<main><h1>Title</h1><p>" + "A sentence. " * 50 + "</p><article><p>Teaser one.</p></article><article><p>Teaser two.</p></article></main>", "Title\n\n" + " ".join(["A sentence."] * 50) + "\n\nTeaser one.\n\nTeaser two."),
        ("<main><p>Lead.</p><article><p>" + "The story. " * 20 + "</p></article></main>", " ".join(["The story."] * 20)),
        ("<article><p>" + "Cook it. " * 30 + "</p><div class='recipe-menu'><p>Soup and bread.</p></div><table class='share-prices'><tr><td>12.5</td></tr></table></article>", " ".join(["Cook it."] * 30) + "\n\nSoup and bread.\n\n12.5"),
        ("<article><p>" + "Cook it. " * 30 + "</p><div class='share-buttons'><a href=x>Send</a> <a href=y>Post</a></div><ul class='related-posts'><li><a href=z>More</a></li></ul></article>", " ".join(["Cook it."] * 30)),
    ],
)
def test_pages_that_hid_their_text(page, text):
    assert extraction.main_text(page) == text


def test_deep_and_unbalanced_pages_take_linear_time():
    import time

    deep = "<article><header>" + "<div>" * 3000 + "<h2>T</h2>" + "</div>" * 3000 + "</header><p>Text.</p></article>"
    assert extraction.main_text(deep) == "T\n\nText."
    start = time.process_time()
    assert extraction.main_text("<article><p>a" + "<i>" * 20_000 + "</b>" * 20_000 + "</article>") == "a"
    assert time.process_time() - start < 5


def test_scores_do_not_depend_on_the_partitions(spark, monkeypatch):
    monkeypatch.setattr(pl, "_SHARD_WORDS", 2000)
    r = np.random.default_rng(7)
    texts = [" ".join(f"w{int(x)}" for x in r.zipf(1.3, 60) % 500) for _ in range(200)] + [None, "", "copy of one"] * 3
    docs = spark.createDataFrame([(i, t, {"a": "b"}) for i, t in enumerate(texts)], "doc_id long, text string, extra map<string,string>")
    found, nets = [], []
    for n in (1, 4, 32):
        dealt = docs.repartition(n, F.xxhash64("doc_id"))
        vocabulary = pl.fit_vocabulary(dealt)
        net = pl.fit(dealt, vocabulary)
        nets.append(net)
        found.append({x["doc_id"]: x["log_likelihood"] for x in pl.score(dealt, vocabulary, net).collect()})
    assert all((nets[0][name] == other[name]).all() for other in nets[1:] for name in net)
    for other in found[1:]:  # products of matrices round by their height, which is that of a batch
        assert all(v == pytest.approx(found[0][i], rel=1e-5) for i, v in other.items())
    # The whole score by a plain version: every word by its window, unknown ones by their own counts as well.
    counts = {}
    for t in texts:
        for w in (t or "").split():
            counts[w] = counts.get(w, 0) + 1
    net64 = {k: v.astype(np.float64) for k, v in net.items()}
    for i in (0, 7, 199):
        hashes, _ = pl.word_hashes([texts[i]])
        ids = vocabulary.lookup(hashes)
        near = [pl.PAD] * pl.SIDE + pl.context_ids(ids, hashes).tolist() + [pl.PAD] * pl.SIDE
        total = 0.0
        for k, (word, spelled) in enumerate(zip(ids, texts[i].split(), strict=True)):
            window = near[k : k + pl.SIDE] + near[k + pl.SIDE + 1 : k + 2 * pl.SIDE + 1]
            hidden = np.tanh(np.concatenate([net64["embedding"][w] for w in window]) @ net64["into"] + net64["into_bias"])
            group, member = divmod(int(word), pl.MEMBERS)
            for z, at in ((hidden @ net64["classes"] + net64["class_bias"], group), (hidden @ net64["members"][group] + net64["member_bias"][group], member)):
                total += z[at] - np.log(np.exp(z).sum())
            if word == pl.UNKNOWN:
                total += np.log(counts[spelled] / max(1.0, vocabulary.counts[pl.UNKNOWN]))
        assert found[0][i] == pytest.approx(total, rel=1e-4)


def test_hashes_of_words():
    texts = ["", "a b  a", None or "", "x" * 64 + " " + "x" * 65 + " " + "x" * 5000 + "\n" + "x" * 65, "é\x0bb\x1cc", "b"]
    hashes, owner = pl.word_hashes(texts)
    words = [w for t in texts for w in re.split(r"[ \t-\r]+", t) if w]
    assert owner.tolist() == [1, 1, 1, 3, 3, 3, 3, 4, 4, 5] and len(words) == len(hashes)
    assert len(set(zip(words, hashes.tolist()))) == len(set(words)) == len(set(hashes.tolist()))


@pytest.mark.parametrize("scale", [1, 400])
def test_log_probabilities_need_no_maximum_of_each_row(scale):
    """Plainly in double precision: logits close together, and so far apart that exponentials would vanish."""
    random = np.random.default_rng(5)
    net = {n: random.standard_normal(s).astype(np.float32) * 0.1 for n, s in pl._SHAPES.items()}
    net["classes"] *= scale
    net["members"] *= scale
    near = np.isfinite([pl._tops(net["classes"], net["class_bias"]), *pl._tops(net["members"], net["member_bias"])])
    assert near.all() if scale == 1 else not near.any()
    ids, around = random.integers(0, pl.PAD, 500), random.integers(0, pl.PAD, (500, 2 * pl.SIDE))
    wide = {n: v.astype(float) for n, v in net.items()}
    hidden = np.tanh(wide["embedding"][around].reshape(500, -1) @ wide["into"] + wide["into_bias"])
    group, member = np.divmod(ids, pl.MEMBERS)
    want = np.zeros(500)
    for logits, chosen in (
        (hidden @ wide["classes"] + wide["class_bias"], group),
        (np.einsum("nh,nhm->nm", hidden, wide["members"][group]) + wide["member_bias"][group], member),
    ):
        logits -= logits.max(axis=1, keepdims=True)
        want += logits[np.arange(500), chosen] - np.log(np.exp(logits).sum(axis=1))
    assert np.allclose(pl.log_probabilities(net, ids, around), want, rtol=1e-4, atol=1e-4)
    before = want.mean()
    pl.train(net, iter([(ids, around)] * 5))
    assert all(np.isfinite(v).all() for v in net.values()) and pl.log_probabilities(net, ids, around).mean() > before


def test_counts_of_common_words_need_no_join(spark, monkeypatch):
    # 4,095 words fill the list; one other word is common, "seldom" and "once" are not.
    monkeypatch.setattr(pl, "_COMMON", pl.PAD, raising=False)
    texts = [" ".join(f"w{i}" for i in range(pl.PAD - 1))] * 60 + ["often"] * 50 + ["seldom"] * 10 + ["once", None]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(4)
    vocabulary = pl.fit_vocabulary(docs)
    written, materialise = [], pl.materialise
    monkeypatch.setattr(pl, "materialise", lambda df, name: written.append(materialise(df, name)) or written[-1])
    probe = spark.createDataFrame([("often",), ("seldom",), ("once",), ("never",), ("often once w1 often never",)], "text string")
    net = pl.start(vocabulary)
    got = {r["text"]: r["log_likelihood"] for r in pl.score(probe, vocabulary, net, keep=["text"]).collect()}
    assert sum(len(r["rare"]) for r in written[0].collect()) == 5  # one each of seldom, once and never; once and never again
    joined = pl.score(probe, replace(vocabulary, common=None), net, keep=["text"])
    assert sum(len(r["rare"]) for r in written[1].collect()) == 8
    for r in joined.collect():
        assert got[r["text"]] == pytest.approx(r["log_likelihood"], rel=1e-12)
    # Where no size of count stays within the bound, all words are joined.
    monkeypatch.setattr(pl, "_COMMON", 100)
    none = pl.fit_vocabulary(docs)
    assert len(none.common[0]) == 0 and none.others == 3 and (none.counts == vocabulary.counts).all()


def test_hashes_are_found_by_their_first_bits():
    random = np.random.default_rng(2)
    some = random.integers(0, 2**64, 3000, np.uint64, endpoint=False)
    for held in ([], [0], [2**64 - 1], [5, 6, 7, 2**63], some[::2], np.append(some[::3], np.array([0, 2**64 - 1], np.uint64))):
        held = np.unique(np.array(held, np.uint64))
        asked = np.concatenate([some, held, held + np.uint64(1), np.array([0, 2**64 - 1], np.uint64)])
        at, found = pl.SortedHashes(held).find(asked)
        assert (found == np.isin(asked, held)).all() and (held[at[found]] == asked[found]).all()


@pytest.mark.parametrize("scale", [1, 400])
def test_training_steps_by_a_plain_version(scale, monkeypatch):
    """In double precision, row by row and without blocks."""
    monkeypatch.setattr(pl, "_BLOCK", 16, raising=False)
    random = np.random.default_rng(6)
    net = {n: random.standard_normal(s).astype(np.float32) * 0.1 for n, s in pl._SHAPES.items()}
    net["classes"] *= scale
    net["members"] *= scale
    plain = {n: v.astype(float) for n, v in net.items()}
    seen = {n: np.full(v.shape, 1e-6) for n, v in plain.items()}
    steps = [(random.integers(0, 200, 90), random.integers(0, pl.PAD + 9, (90, 2 * pl.SIDE))) for _ in range(2)]
    for ids, around in steps:
        slopes = {n: np.zeros_like(v) for n, v in plain.items()}
        for word, window in zip(ids, around, strict=True):
            inputs = plain["embedding"][window].ravel()
            hidden = np.tanh(inputs @ plain["into"] + plain["into_bias"])
            group, member = divmod(int(word), pl.MEMBERS)
            back = 0
            for weights, bias, at, chosen in (("classes", "class_bias", ..., group), ("members", "member_bias", group, member)):
                logits = hidden @ plain[weights][at] + plain[bias][at]
                error = np.exp(logits - logits.max())
                error /= error.sum()
                error[chosen] -= 1
                slopes[weights][at] += np.outer(hidden, error)
                slopes[bias][at] += error
                back = back + plain[weights][at] @ error
            back = back * (1 - hidden**2)
            slopes["into"] += np.outer(inputs, back)
            slopes["into_bias"] += back
            np.add.at(slopes["embedding"], window, (plain["into"] @ back).reshape(2 * pl.SIDE, pl.EMBEDDING))
        for n, slope in slopes.items():
            seen[n] += (slope / len(ids)) ** 2
            plain[n] -= 0.05 * slope / len(ids) / np.sqrt(seen[n])
    assert pl.train(net, iter(steps)) == 180
    for n, v in net.items():
        assert np.allclose(v, plain[n], rtol=1e-3, atol=1e-3 if scale == 1 else 5e-3), n
