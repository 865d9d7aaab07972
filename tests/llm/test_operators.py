"""Corpus operators against plain versions, on hand-made rows with nulls, copies, ties and odd columns."""

import hashlib
import random
import zlib

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm import lines, minhash, mixing, packing, quality, spots, suffixes, tokens, vectors, wrappers

DOCS = "doc_id bigint, text string, source string, n bigint, spans string, score double"


def words(rng, n):
    return " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 9))) for _ in range(n))


def corpus():
    rng = random.Random(3)
    shared = words(rng, 30)
    texts = [words(rng, rng.randint(1, 120)) for _ in range(25)]
    texts += [f"{words(rng, 8)}\n{shared}\n{words(rng, 8)}" for _ in range(8)]
    texts += [texts[3], texts[3], texts[4] + " and more", None, "", "", "é" * 150, "a" * 400, "ab" * 200, " \n\t\n"]
    base = texts[5].split()
    texts.append(" ".join(base[:-1] + ["changed"]))
    rows = [(i, t, f"s{i % 3}" if i % 7 else None, i, "x", 0.5) for i, t in enumerate(texts)]
    return rows + [(None, shared * 2, "s0", 0, None, None), (7, words(rng, 40), "s1", 1, None, None), (3, texts[3], "s0", 3, "x", 0.5)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(corpus(), DOCS).repartition(3)


def plain(rows):
    return sorted(map(repr, rows))


def test_suffix_dedup(docs):
    found = suffixes.query(docs).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()
    assert plain(map(tuple, found)) != []
    order = {}
    rows = [(r[0], r[1]) for r in corpus()]
    unique = [r for r in rows if sum(x[0] == r[0] for x in rows) == 1]
    expected = {repr(r) for r in brute.removal_rows(rows, 100)}
    mine = {repr(tuple(r)) for r in found if r["doc_id"] in {u[0] for u in unique}}
    assert mine <= expected and len(mine) == len(unique)


def test_difference_cover_order():
    rng = np.random.default_rng(0)
    data = rng.integers(97, 99, 700).astype(np.uint8)
    wanted = np.arange(0, 600)
    order = suffixes.sorted_windows(data, wanted, 40)
    parts = [data[i : i + 40].tobytes() for i in order]
    assert sorted(order.tolist()) == wanted.tolist() and parts == sorted(parts)


def test_names_of_wide_ranks():
    parts = [np.array([0, 1, 0, 1]), np.array([1 << 21, 0, 1 << 21, 0]), np.array([5, 5, 6, 5])]
    assert suffixes._names(parts).tolist() == [0, 2, 1, 2]


def test_suffix_dedup_passage_in_thousands(spark):
    rng = random.Random(11)
    passage = words(rng, 24)
    rows = [(i, f"{words(rng, 12)} {passage} {words(rng, 12)}") for i in range(2500)]
    table = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    _, marks, crowded = suffixes._compare_anchors(table.selectExpr("doc_id id", "0L tie", "text"), 100)
    sizes = marks.select(F.explode("marks").alias("m")).groupBy("m.h").count()
    assert not crowded.isEmpty() and sizes.where(F.col("count") > suffixes.TOGETHER).isEmpty()
    found = suffixes.query(table).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()
    assert plain(map(tuple, found)) == plain(brute.removal_rows(rows, 100))


def test_line_dedup(docs):
    found = lines.drop_repeated_lines(docs, 5, 20).select("doc_id", "n_lines", "n_dropped", "text").collect()
    assert plain(map(tuple, found)) == plain(brute.thinned_lines([(r[0], r[1]) for r in corpus()], 5, 20))


def test_line_dedup_empty(docs):
    assert lines.drop_repeated_lines(docs.limit(0)).count() == 0


def test_near_duplicates(docs):
    found = {}
    for r in minhash.near_duplicates(docs).collect():
        found.setdefault(r["doc_id"], r["component_id"])
    assert found[33] == found[34] == 3 and found[43] == 5
    assert found[37] == 37 and found[38] == 38
    kept = minhash.keep_one(docs)
    assert kept.columns == docs.columns and kept.where("doc_id in (33, 34, 43)").count() == 0
    assert kept.where("doc_id = 3").count() == 1


def test_rows_without_id_are_documents_of_their_own(spark):
    rng = random.Random(12)
    texts = [words(rng, 60) for _ in range(6)]
    near = lambda t: " ".join(t.split()[:-1] + ["changed"])
    rows = [(None, t) for t in texts[:4]] + [(None, texts[0]), (None, None), (None, "..."), (5, texts[4]), (5, texts[5])]
    rows += [(1, near(texts[1])), (2, near(texts[2])), (9, near(texts[4]))]
    table = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    kept = sorted(map(repr, minhash.keep_one(table).collect()))
    stay = [(None, t) for t in texts[:4]] + [(None, None), (None, "..."), (5, texts[4]), (5, texts[5])]
    assert kept == sorted(map(repr, spark.createDataFrame(stay, table.schema).collect()))
    found = {(r["doc_id"], r["component_id"]) for r in minhash.near_duplicates(table).collect()}
    assert found == {(None, None), (1, None), (2, None), (5, 5), (9, 5)}
    assert minhash.query(table).where("kept").count() == len(stay) + 1


def test_near_duplicates_empty(docs):
    assert minhash.near_duplicates(docs.limit(0)).count() == 0


def test_consistent_samples_estimate_jaccard():
    rng = np.random.default_rng(1)
    kinds = np.unique(rng.integers(0, 2**63, 300).astype(np.uint64))
    a, b = np.ones(300), np.ones(300)
    b[:60] = 3.0
    same = minhash.consistent_samples(kinds, a, 2000) == minhash.consistent_samples(kinds, b, 2000)
    assert abs(same.mean() - minhash.likeness((kinds, a), (kinds, b))) < 0.05


def test_fingerprints(docs):
    unique = docs.where("doc_id is not null and doc_id not in (3, 7)")
    found = {r["doc_id"]: r for r in spots.query(unique).collect()}
    rows = sorted(((r[0], r[1] or "") for r in corpus() if r[0] in found), reverse=True)
    for k, (i, text) in enumerate(rows):
        cut, nxt = len(text) // 3, rows[(k + 1) % len(rows)][1]
        edited = text[: len(text) - cut] + nxt[:cut]
        assert found[i]["n_chars"] == len(text) and found[i]["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert 0 <= found[i]["near_edited"] <= 1 and 0 <= found[i]["near_next"] <= 1
    assert found[33]["fingerprint"] == found[34]["fingerprint"]


def test_spot_pairs(spark):
    rng = random.Random(5)
    base = [rng.sample(range(1000), 40) for _ in range(12)]
    sets = base + [b[:36] + rng.sample(range(1000, 2000), 4) for b in base]
    frame = spark.createDataFrame([(i, sorted(set(s))) for i, s in enumerate(sets)] + [(None, [1]), (99, [])], "id bigint, signatures array<bigint>")
    found = {(min(r["a"], r["b"]), max(r["a"], r["b"])) for r in spots.spot_pairs(frame, 0.75).collect()}
    sets = [set(s) for s in sets]
    expected = {(i, j) for i in range(24) for j in range(i + 1, 24) if len(sets[i] & sets[j]) / len(sets[i] | sets[j]) >= 0.75}
    assert found == expected


def test_mixing(docs):
    mixed = mixing.mix_sources(docs, repeats=2.0)
    taken = {}
    for r in mixed.groupBy("source", "doc_id", "text").count().collect():
        taken[r["source"], r["doc_id"], r["text"]] = r["count"]
    assert len(taken) == docs.select("source", "doc_id", "text").distinct().count()
    weighed = mixing.mix_sources(docs, budget=500.0, repeats=None, entropy=1.0)
    sums = {r["source"]: r["t"] for r in weighed.groupBy("source").agg(F.sum(mixing.word_tokens()).alias("t")).collect()}
    assert all(t <= 126 for t in sums.values())
    assert mixing.mix_sources(docs.limit(0)).columns == docs.columns + ["mix_pass", "mix_turn"]


def test_packing(docs):
    from tokenizers import Tokenizer

    path = packing.default_tokenizer()
    tokenizer = Tokenizer.from_file(path)
    rows = packing.pack_documents(docs.where("doc_id not in (3, 7)"), path, length=64, windows=4, with_ids=True).collect()
    whole, windows = {}, {}
    for r in rows:
        assert zlib.crc32(bytes(r["ids"])) == r["ids_crc32"] and len(r["ids"]) == 4 * r["length"]
        whole.setdefault(r["doc_id"], []).append((r["start"], bytes(r["ids"])))
        windows.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for r in corpus():
        if r[0] in whole:
            ids = np.array(tokenizer.encode(r[1] or "", add_special_tokens=False).ids + [1], "<u4").tobytes()
            assert b"".join(p for _, p in sorted(whole[r[0]])) == ids
    for pieces in windows.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 64


@pytest.mark.parametrize("text", ["Don't stop. THE end, <|endoftext|> x\x01y ÀÉ straße 12 ok!", "", "a b c", "İstanbul ΟΔΟΣ."])
def test_unit_encoder(text):
    encoder = packing.UnitEncoder(packing.default_tokenizer(), 1000)
    ids = encoder.tokenizer.encode(text, add_special_tokens=False).ids
    assert encoder.encode([text, text])[1] == np.array(ids, "<u4").tobytes()


def test_token_counts():
    vocabulary = tokens.Vocabulary({"▁": -3.0, "▁a": -2.0, "a": -2.5, "b": -2.5, "ab": -4.0, "▁ab": -6.0, "aba": -4.5}, True)
    counter = tokens.Counter(vocabulary)

    def slow(text):
        best = {0: (0.0, 0)}
        for end in range(1, len(text) + 1):
            for start in range(end):
                piece = text[start:end]
                if piece in vocabulary.scores:
                    found = (best[start][0] + vocabulary.scores[piece], best[start][1] + 1)
                elif end - start == 1:
                    found = (best[start][0] - 16.0, best[start][1] + len(piece.encode()))
                else:
                    continue
                if end not in best or found[0] > best[end][0]:
                    best[end] = found
        return best[len(text)][1]

    rng = random.Random(2)
    for _ in range(200):
        text = "".join(rng.choice("ab é\n") for _ in range(rng.randint(1, 12)))
        assert counter.count(text) == slow("▁" + text.replace(" ", "▁"))
    assert counter.count("") == 0


def test_token_count_query(docs):
    assert tokens.query(docs).count() == docs.count()


def test_vectors(spark):
    rng = np.random.default_rng(4)
    base = rng.normal(size=(6, 8))
    rows = [(i, (base[i % 6] + rng.normal(size=8) * 0.15 * (i % 4)).tolist(), int(i % 6 // 3)) for i in range(80)]
    rows += [(80, rows[3][1], rows[3][2]), (81, rows[3][1], None), (82, None, 1), (83, [0.0] * 8, 1), (84, [], 0), (85, [float("nan")] * 8, 0)]
    rows += [(86, [None] + [1.0] * 7, 0), (87, [1.0, 2.0], 0)]
    table = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int")
    before = vectors.CELL_ROWS, vectors.BLOCK
    vectors.CELL_ROWS, vectors.BLOCK = 8, 4
    try:
        found = [tuple(r) for r in vectors.near_vectors(table).collect()]
    finally:
        vectors.CELL_ROWS, vectors.BLOCK = before
    assert sorted(found) == sorted(brute.vector_rows(rows))


def test_quality(spark):
    rng = random.Random(6)
    rows = [(i, words(rng, 30) if i % 2 else words(rng, 30).replace(" ", "$$ "), None, i, None, None) for i in range(60)] + [(60, None, None, 0, None, None)]
    docs = spark.createDataFrame(rows, DOCS)
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)] + [(None, 1), (61, None)], "doc_id bigint, quality int")
    model = quality.fit_quality(docs, labels, ~quality.held_out(), steps=2000)
    scored = quality.score_quality(docs, model)
    assert scored.columns == docs.columns[:-1] + ["score"]
    right = [(r["score"] >= 0.5) == (r["doc_id"] % 2 == 1) for r in scored.collect() if r["doc_id"] < 60]
    assert sum(right) >= 57
    untaught = quality.fit_quality(docs, labels.limit(0), F.lit(True))
    assert {r["score"] for r in quality.score_quality(docs, untaught).collect()} == {0.5}


def test_extraction(spark):
    page = (
        "<html><head><title>t</title><script>var a='<p>no</p>'</script></head><body><nav><a>Home</a></nav><div class='cookie-notice'>ok?</div>"
        "<article><h1>T{0}</h1><p>One&amp;two <b>bold</b>\n {0}<br><p>Second {0}</p><div class=ad>buy</div><form>x</form>"
        "<section id=comments><p>hi {0}</p></section></article><footer>&copy; h</footer>"
    )
    rows = [(i, "http://h.example/x", page.format(i)) for i in range(7)] + [(8, None, None), (9, "odd", "plain <i>text")]
    found = {r["page_id"]: r["text"] for r in wrappers.query(spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect()}
    assert found[3] == "T3\n\nOne&two bold 3\n\nSecond 3" and found[8] == "" and found[9] == "plain text"


def text_of_page(html):
    root, blocks = wrappers.parse(html)
    return wrappers.main_text(root, blocks, [False] * len(blocks))


@pytest.mark.parametrize(
    "html, text",
    [
        ("<body><svg class=i/><article><p>Story one</p></article>", "Story one"),
        ("<body><svg class=i><path/></svg><article><p>Story one</p></article>", "Story one"),
        ("<body><object data=x/><article><p>Story one</p></article>", "Story one"),
        ("<body><script>var a = 1;<article><p>Story one</p></article>", "Story one"),
        ("<article><p>As <math><mi>x</mi><mo>=</mo><mn>1</mn></math> <math/> shows</p></article>", "As x=1 shows"),
        ("<body><div class='content no-sidebar'><p>Story one</p></div><div class=sidebar><p>side</p></div>", "Story one"),
        ("<body class=has-sidebar><div class='with-comments'><p>Story one</p></div><div id=comments><p>reply</p></div>", "Story one"),
        ("<body><form id=aspnetForm><div><p>Story one is a long line of its own</p></div><nav>Home</nav></form>", "Story one is a long line of its own"),
        ("<body><div><p>Short</p></div><div class=comments><p>A reply that is much longer than the story was, by far</p></div>", "Short"),
        ("<body><svg><path><p>Story one</p><svg></svg>", "Story one"),
        ("<body><div hidden><p>A hidden line that is all there is</p></div>", ""),
        ("<body><div><p>Story one is a long line of its own</p></div><form><p>mail</p></form>", "Story one is a long line of its own"),
    ],
)
def test_article_text_stays(html, text):
    assert text_of_page(html) == text


def test_template_text_goes(spark):
    page = "<body><div><p>Read our house rules before you write</p><p>Story number {0} {0} {0}, told in a long line of its own</p></div>"
    rows = [(i, "http://h/x", page.format(i * 37)) for i in range(9)]
    found = wrappers.query(spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect()
    assert all("house rules" not in r["text"] and "Story number" in r["text"] for r in found)


def test_tree_matching():
    a, b = (wrappers.number(wrappers.parse(f"<body><ul>{x}</ul><p>t</p>")[0]) for x in ("<li>1<li>2<li>3", "<li>1<li>3"))
    assert len(wrappers.align(a, b)) == 6


def test_words_of_latin_letters_take_the_direct_way(monkeypatch):
    from tokenizers import Tokenizer

    path = packing.default_tokenizer()
    encoder, whole = packing.UnitEncoder(path, 1000), Tokenizer.from_file(path)
    words = ["éa", "Été,", "ÿÞß.", "straße", "ÀÉ!", "añb", "Ü", "naïveté;"]
    odd = ["cúİ.", "İ", "ſé", "Łé", "é́", "µé", "é×", "é$$", "ªº", "Σς.", "l'été"]
    monkeypatch.setattr(encoder, "_learn_words", lambda plain: pytest.fail(f"not direct: {plain}") if plain else None)
    direct = encoder.encode(words)
    monkeypatch.undo()
    for unit, raw in zip(words + odd, direct + encoder.encode(odd)):
        assert np.frombuffer(raw, "<u4").tolist() == whole.encode(unit, add_special_tokens=False).ids, unit
