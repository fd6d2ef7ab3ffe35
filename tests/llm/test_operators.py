"""Dealt operators against brute force on small rows: NULLs, empty and very long texts, ties, repeats, clashing columns."""
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from retailq.llm import (decontamination, language_id, license_scan, near_dedup, piece_encoding, sharding, token_counts,
                         token_output, toxicity, vector_search)
from retailq.llm.common import work_path

DOCS = "doc_id long, text string, lang string, source string, n_chars long, pos int, token string, `key` string"
WORDS = [f"w{i}" for i in range(400)]
BASE = " ".join(WORDS)
TEXTS = [
    (1, None), (2, ""), (3, " "), (4, "one"), (5, BASE), (6, BASE), (7, BASE.replace("w200 ", "CHANGED ")), (8, "a  b\n\n c "),
    (9, "Released under the MIT License. <|endoftext|> end"), (10, "naïve É日本語 😀 " * 5), (11, "x" * 30000),
    (12, " ".join(WORDS * 60)), (None, "no id here"), (13, "one"), (13, "one"), (14, "THE " + " ".join(WORDS[50:63]) + " tail"),
    (15, "...!!!"), (16, "▁raw ▁▁mark  <s>"),
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "en", "s", 0, 1, "t", "k") for i, t in TEXTS]
    return spark.createDataFrame(rows, DOCS).repartition(3).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


def test_token_output_round_trip(spark, docs, empty):
    from tokenizers import Tokenizer
    path, name = work_path(spark, "t"), public_tokenizers.path("byte_bpe_50k.json")
    token_output.write_tokens(docs, path, name, end_id=2, segment_tokens=300)
    got = sorted((r.start, r.doc_id, r.n_tokens, r.ids_crc32) for r in token_output.read_tokens(spark, path).collect())
    tok = Tokenizer.from_file(name)
    start, expected = 0, []
    for i, t in sorted(TEXTS, key=lambda d: (d[0] is not None, d[0] or 0)):
        ids = tok.encode(t or "", add_special_tokens=False).ids + [2]
        expected.append((start, i, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert got == expected
    none = work_path(spark, "t")
    token_output.write_tokens(empty, none, name, end_id=2)
    assert token_output.read_tokens(spark, none).count() == 0


@pytest.mark.parametrize("percentile", [0.5, 0.9, 1.0])
def test_blocks(percentile):
    rng = np.random.default_rng(1)
    for n in (1, 255, 256, 257, 5000):
        ids = np.where(rng.random(n) < 0.05, rng.integers(0, 2**32, n), rng.integers(100, 900, n)).astype(np.uint32)
        payload = token_output.pack_segment([7, None], np.array([n - 1, 1]), ids, percentile)
        names, counts, back = token_output.read_segment(payload)
        assert names == [7, None] and counts.tolist() == [n - 1, 1] and (back == ids).all()
        assert (token_output.read_range(payload, n // 3, n) == ids[n // 3:]).all()


def test_token_counts_and_cache(spark, docs, empty):
    from tokenizers import Tokenizer
    path, name = work_path(spark, "cache"), public_tokenizers.path("word_bpe_49k.json")
    tok = Tokenizer.from_file(name)
    for _ in range(2):  # the second time everything comes from the cache
        got = Counter(map(tuple, token_counts.count_tokens(docs, name, 50, path).collect()))
        counts = [(i, len((t or "").encode()), len(tok.encode(t or "", add_special_tokens=False).ids)) for i, t in TEXTS]
        assert got == Counter((i, b, n, n > 50) for i, b, n in counts)
    stored = spark.read.parquet(path)
    assert stored.count() == stored.select("content").distinct().count()
    assert token_counts.count_tokens(empty, name, 50).count() == 0


def test_piece_encoding(spark, docs, empty):
    import sentencepiece
    name = public_tokenizers.path("piece_bpe_32k.model")
    lib = sentencepiece.SentencePieceProcessor(model_file=name)
    got = Counter((r.doc_id, tuple(r.ids), r.round_trip) for r in piece_encoding.encode_documents(docs, name).collect())
    assert got == Counter((i, tuple(lib.encode(t or "")), True) for i, t in TEXTS)
    assert piece_encoding.encode_documents(empty, name).count() == 0
    model = piece_encoding.PieceModel(name, max_words=3)
    rng = np.random.default_rng(2)
    texts = ["".join(rng.choice(list("abcdeth  ▁éü\n日"), rng.integers(1, 300))) for _ in range(60)]
    for _ in range(2):
        ids, counts = model.encode(pa.array(texts))
        ends = np.cumsum(counts)
        assert [ids[e - c:e].tolist() for e, c in zip(ends, counts)] == lib.encode(texts)


def test_near_dedup(spark, docs, empty):
    got = {r.doc_id: r for r in near_dedup.groups(docs).collect()}
    assert len(got) == len({i for i, _ in TEXTS})
    sizes = {1: 0, 2: 0, 3: 0, 4: 1, 5: 396, 7: 396}
    assert {i: got[i].n_shingles for i in sizes} == sizes
    assert [got[i].component_id for i in (1, 2, 4, 5, 6, 7, 13)] == [1, 2, 4, 5, 5, 5, 4]
    assert got[None].component_id is None and got[None].kept and got[5].kept and not got[6].kept
    assert near_dedup.groups(empty).count() == 0
    assert near_dedup.keep_one_each(docs).columns == docs.columns


def test_near_dedup_repeated_ids(spark):
    a, b, near_b = "alpha " + BASE, " ".join(reversed(WORDS)), " ".join(reversed(WORDS)).replace("w9 ", "other ")
    rows = [(1, a), (5, a), (5, b), (7, b), (9, near_b), (5, ""), (5, ""), (11, "alone one two three four five"), (11, "quite another text of its own here"),
            (11, "alone one two three four five"), (None, b)]
    frame = spark.createDataFrame([(*r, "s", i) for i, r in enumerate(rows)], "doc_id long, text string, source string, n long").repartition(4)
    got = {(r.doc_id, r.component_id, r.kept) for r in near_dedup.groups(frame).collect()}
    # a doc_id with two texts makes both reachable; its wordless rows are linked with nothing
    assert got == {(1, 1, True), (5, 1, False), (7, 1, False), (9, 1, False), (5, 5, True), (11, 11, True), (None, None, True)}
    kept = near_dedup.keep_one_each(frame)
    assert kept.columns == frame.columns
    # of each group of similar texts one row stays, so no text is lost that has no similar one
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=repr) == sorted([
        (1, a), (5, b), (5, ""), (5, ""), (11, "alone one two three four five"), (11, "quite another text of its own here"), (None, b)], key=repr)


def test_near_dedup_against_brute_force(spark):
    rng = np.random.default_rng(3)
    texts = {}
    for family in range(6):
        base = [f"f{family}x{i}" for i in range(120)]
        for copy in range(25):
            words = list(base)
            for at in rng.choice(120, rng.integers(0, 5), replace=False):
                words[at] = f"e{family}{copy}{at}"
            texts[len(texts)] = " ".join(words)
    sets = {i: {tuple(t.split()[a:a + 5]) for a in range(116)} for i, t in texts.items()}
    low = {i: i for i in sets}
    for _ in sets:
        for a in sets:
            for b in sets:
                if a < b and low[a] != low[b] and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b]):
                    keep, drop = sorted((low[a], low[b]))
                    low = {k: keep if v == drop else v for k, v in low.items()}
        break
    frame = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in near_dedup.groups(frame, near_dedup.Settings(cell=8)).collect()}
    assert got == low and len(set(low.values())) > 6


def test_decontamination(spark, docs, empty):
    items = spark.createDataFrame([(1, " ".join(WORDS[40:70])), (2, "the  mit"), (3, None), (4, ""), (5, "one"), (6, "absent words"),
                                   (None, "end")], "item_id long, text string")
    got = {(r.doc_id): r for r in decontamination.scan(docs, items).collect()}
    assert (got[14].n_words, got[14].n_hit, got[14].n_items, got[14].contaminated) == (15, 13, 1, True)
    assert (got[5].n_hit, got[9].n_hit, got[9].n_items, got[4].n_hit, got[1].n_hit) == (30, 3, 1, 1, 0)
    assert not got[1].contaminated and got[1].n_words == 0 and got[12].n_hit == 30 * 60
    assert decontamination.scan(docs, items).count() == len(TEXTS)
    assert decontamination.scan(empty, items).count() == 0
    assert not decontamination.scan(docs, items.limit(0)).where("contaminated").count()
    clean = decontamination.keep_clean(docs, items)
    assert clean.columns == docs.columns and clean.where("doc_id in (4, 13, 14)").count() == 0


def test_license_scan(spark, docs, empty):
    known = license_scan.templates(spark)
    got = [tuple(r) for r in license_scan.scan(docs, known).collect()]
    assert got == [(9, "MIT-mention", 1.0, 0)] and license_scan.scan(empty, known).count() == 0
    edited = license_scan.TEMPLATES["MIT"].replace("copy", "duplicate", 1)
    frame = spark.createDataFrame([(1, f"{BASE} {edited} {BASE}"), (1, f"{BASE} {edited} {BASE}")], "doc_id long, text string")
    found = license_scan.scan(frame, known).collect()
    assert len(found) == 1 and found[0].license_id == "MIT" and 0.8 <= found[0].containment < 1


def test_license_scan_misses_nothing(spark):
    """Exact and edited copies of every template at begin, middle and end, against all windows by brute force."""
    rng = np.random.default_rng(7)
    parted = lambda text: [w for w in re.split(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", text.lower()) if w]
    shingles = lambda words: {tuple(words[i:i + 3]) for i in range(len(words) - 2)}
    texts, expected = {}, {}
    for name, template in license_scan.TEMPLATES.items():
        words, known = parted(template), shingles(parted(template))
        for trial in range(120):
            copy = list(words)
            if trial % 2 and len(known) >= 5:  # as many edits as the bound allows: 3 shingles for an inner word, 1 at an end
                spare = len(known) // 5
                for at in [0] * (spare % 3 > 0) + [-1] * (spare % 3 > 1) + [4 + 4 * k for k in range(spare // 3)]:
                    copy[at] = f"edit{trial}"
            before, after = [(0, 40), (30 + trial % 7, 40), (30 + trial % 7, 0)][trial % 3]
            filler = lambda n: [f"f{x}" for x in rng.integers(0, 10**6, n)]
            whole = filler(before) + copy + filler(after)
            step = max(1, len(words) // 4)
            best = max((len(known & shingles(whole[k:k + len(words) + step])) / len(known), -k) for k in range(0, len(whole), step))
            if best[0] >= 0.8:
                expected[len(texts), name] = (best[0], -best[1])
            texts[len(texts)] = " ".join(whole)
    frame = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(4)
    got = {(r.doc_id, r.license_id): (r.containment, r.first_word) for r in license_scan.scan(frame, license_scan.templates(spark)).collect()}
    assert len(expected) > 1200 and sum(0.8 <= c < 1 for c, _ in expected.values()) > 300
    assert {k: v for k, v in expected.items() if k not in got} == {}
    of_own = {k: v for k, v in got.items() if k in expected}
    assert of_own == expected


def test_vector_search(spark):
    rng = np.random.default_rng(4)
    data = rng.normal(size=(900, 8)).astype(np.float32)
    data[10] = data[11]
    rows = [(i, v.tolist(), 0) for i, v in enumerate(data)] + [(11, data[11].tolist(), 0), (2000, None, 0), (2001, [0.0] * 8, 0),
            (2002, [float("nan")] * 8, 0), (2003, [None] * 8, 0), (2004, [1.0] * 3, 0), (None, [1.0] * 8, 0)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    got = vector_search.nearest(frame, frame.where("vec_id % 100 = 0"), 10, rows_per_shard=300).collect()
    wide = data.astype(float)
    expected = {}
    for q in range(0, 900, 100):
        far = np.sqrt(((wide - wide[q]) ** 2).sum(1))
        far[q] = np.inf
        expected[q] = np.lexsort((np.arange(900), far))[:10].tolist()
    found = {}
    for r in sorted(got, key=lambda r: (r.query_id, r["rank"])):
        found.setdefault(r.query_id, []).append(r.vec_id)
    assert found == expected
    loose = vector_search.nearest(frame, frame.where("vec_id % 100 = 0"), 10, factor=1.3, rows_per_shard=300).collect()
    met = sum(r.vec_id in expected[r.query_id] for r in loose)
    assert met >= 0.9 * 90
    assert vector_search.nearest(frame.limit(0), frame.limit(0), 10).count() == 0


def test_sharding(spark, docs, empty):
    tree = sharding.uniform_tree(3, 2, 4)
    rows = sharding.assign_shards(docs, tree, rows_per_run=3).collect()
    assert len(rows) == len(TEXTS) and all(r.grown_shard in (r.shard, 24) for r in rows)
    for shard in {r.shard for r in rows}:
        slots = sorted(r.slot for r in rows if r.shard == shard)
        assert slots == list(range(len(slots)))
    assert {r.doc_id: (r.size, r.text_crc32) for r in rows}[4] == (11, zlib.crc32(b"one"))
    assert sharding.assign_shards(empty, tree).count() == 0
    many = spark.range(20000).select(F.col("id").cast("string").alias("key"))
    placed = sharding.place(many, "key", tree, "a")
    heavier = tuple(sharding.Shard(s.region, s.rack, s.shard, 2.0 if s.shard == 5 else 1.0) for s in tree)
    moved = sharding.place(placed, "key", heavier, "b").where("a <> b")
    # Weights change in region 0 alone: no row moves between two shards outside it.
    assert moved.count() > 0 and moved.where("a >= 8 and b >= 8").count() == 0
    share = placed.groupBy("a").count().agg(F.min("count"), F.max("count")).first()
    assert share[0] > 650 and share[1] < 1050


def test_sampled_ids_are_the_smallest_hashes(spark):
    from retailq.llm.common import sampled_ids
    rows = spark.createDataFrame([(i, "a" if i % 3 else "b") for i in range(9000)] + [(i, "c") for i in range(5)], "doc_id long, g string").repartition(4)
    placed = rows.select("doc_id", "g", F.shiftrightunsigned(F.xxhash64("doc_id"), 1).alias("p")).collect()
    for most in (1, 7, 300):
        got = {(r.g, r.doc_id) for r in sampled_ids(rows, "g", most).collect()}
        assert got == {(g, r.doc_id) for g in "abc" for r in sorted((r for r in placed if r.g == g), key=lambda r: r.p)[:most]}


def test_language_pieces_and_margin(spark):
    text = " ".join(f"word{i}" for i in range(2000))
    cut = language_id.pieces(text, 500, 48)
    assert 300 < len(cut) < 900 and all(w in text.split() for w in cut.decode().split())
    at = [text.index(w) for w in cut.decode().split()]
    assert min(at) < len(text) / 8 and max(at) > len(text) * 7 / 8  # spread over the whole text
    assert language_id.pieces("short one", 500, 48) == b"short one"
    rng = np.random.default_rng(4)
    vocab = {lang: ["".join(rng.choice(list(letters), 7)) for _ in range(120)] for lang, letters in (
        ("aa", "abcdefgh"), ("bb", "ijklmnop"), ("cc", "qrstuvwx"))}
    some = lambda lang, n: " ".join(rng.choice(vocab[lang], n))
    rows = [(i, some(lang, 60), lang) for i, lang in enumerate(["aa", "bb", "cc"] * 200)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(4)
    model, margin = language_id.narrow_margin(frame, settings=language_id.Settings(docs_per_language=60, held_out_docs=40))
    assert 0 < margin < 0.5
    mixed = [(i, some(a, 30) + " " + some(b, 30), None) for i, (a, b) in enumerate([("aa", "bb"), ("bb", "cc"), ("aa", "cc")] * 10)]
    kept = lambda r: language_id.keep_identified(spark.createDataFrame(r, "doc_id long, text string, lang string"), model, margin).count()
    assert kept(mixed) <= 3 and kept(rows) >= 0.98 * len(rows)


def test_language_id(spark, docs, empty):
    rng = np.random.default_rng(5)
    stems = {"aa": ["kala", "suomi", "talo", "vesi"], "bb": ["strom", "haupt", "licht", "zeit"]}
    text = lambda lang: " ".join(rng.choice(stems[lang]) + rng.choice(stems[lang]) for _ in range(40))
    rows = [(i, text("aa" if i % 2 else "bb"), "aa" if i % 2 else "bb") for i in range(200)] + [(900, None, "aa"), (901, "123 !", None)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language_id.fit(frame, F.col("doc_id") < 100)
    got = {r.doc_id: r for r in language_id.identify(frame, model, ["doc_id"]).collect()}
    assert sum(got[i].lang_pred == ("aa" if i % 2 else "bb") for i in range(100, 200)) >= 95
    assert (got[900].lang_pred, got[901].lang_pred, got[901].score) == ("und", "und", 0.0)
    assert language_id.keep_identified(docs, model, 0.0).columns == docs.columns
    assert language_id.identify(empty, language_id.fit(empty), ["doc_id"]).count() == 0


def test_toxicity(spark, docs, empty):
    rng = np.random.default_rng(6)
    plain = [f"{a}{b}{c}" for a in ("ba", "ke", "lo", "mi") for b in ("ta", "so", "ri") for c in ("na", "fe", "du")]
    rows, labels = [], []
    for i in range(500):
        words = list(rng.choice(plain, 80))
        if i % 4 == 0:
            for at in rng.choice(80, 6, replace=False):
                words[at] = rng.choice(["zwurgle", "krampftz", "yxylott"])
        rows.append((i, " ".join(words)))
        labels.append((i, 1, int(i % 4 == 0)))
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    known = spark.createDataFrame(labels + [(None, 1, 1), (3, 1, None)], "doc_id long, quality int, toxic int")
    model = toxicity.fit(frame, known, F.col("doc_id") % 5 != 0)
    got = {r.doc_id: r for r in toxicity.score_toxicity(frame, model, ["doc_id"]).collect()}
    held = [i for i in range(500) if i % 5 == 0]
    assert sum(got[i].predicted == int(i % 4 == 0) for i in held) >= 0.95 * len(held)
    scored = toxicity.score_toxicity(docs, model, ["doc_id"]).collect()
    assert len(scored) == len(TEXTS) and all(0 <= r.score <= 1 for r in scored)
    assert toxicity.keep_ordinary(docs, model).columns == docs.columns
    assert toxicity.score_toxicity(empty, toxicity.fit(empty, known.limit(0), F.lit(True)), ["doc_id"]).count() == 0


def test_toxicity_of_long_texts(spark):
    """Toxic passages that lie late in the texts are learnt, and whole texts of several 100,000 characters judged alike."""
    rng = np.random.default_rng(8)
    parts = [c + v for c in "bklmst" for v in "aeo"]
    plain = [a + b + c for a in parts for b in parts for c in parts]
    odd = ["zwurgle", "krampftz", "yxylott"]

    def text(size, toxic):
        words = rng.choice(plain, size).tolist()
        for at in rng.choice(np.arange(size - 60, size), 12, replace=False) if toxic else ():
            words[at] = str(rng.choice(odd))
        return " ".join(words)

    rows = [(i, text(int(rng.choice([1400, 1800, 6000])), i % 4 == 0)) for i in range(240)]  # 9,800 characters at least
    assert min(len(t) for _, t in rows) > 9000
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    known = spark.createDataFrame([(i, 1, int(i % 4 == 0)) for i, _ in rows], "doc_id long, quality int, toxic int")
    model = toxicity.fit(frame, known, F.col("doc_id") % 5 != 0)
    long = [(1000 + i, text(60_000, i % 2 == 0)) for i in range(8)]
    assert min(len(t) for _, t in long) > 300_000
    scored = toxicity.score_toxicity(frame.unionByName(spark.createDataFrame(long, frame.schema)), model, ["doc_id"])
    got = {r.doc_id: r.predicted for r in scored.collect()}
    held = [i for i in range(240) if i % 5 == 0]
    assert sum(got[i] == int(i % 4 == 0) for i in held) >= 0.95 * len(held)
    assert [got[1000 + i] for i in range(8)] == [1, 0] * 4


def test_pipeline_stages(spark, tmp_path, docs):
    import corpus_pipeline
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "toxicity", "near_dedup", "decontamination", "piece_encoding"]
    folder = str(tmp_path)
    docs.write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(4, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(1, " ".join(WORDS[50:63]))], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    left = {r.doc_id for r in corpus_pipeline.run(spark, folder).collect()}
    # Without letters 1, 2, 3, 15 go; copies 6, 7, 12 (the same words over and over) and 13; 14 is mostly benchmark.
    assert left == {4, 5, 8, 9, 10, 11, None, 16}


def test_pipeline_drops_near_copies_from_four_fifths_on(spark):
    import corpus_pipeline
    words = WORDS[:104]  # 100 shingles; two words changed leave 90 of 110
    edited = [f"e{i}" if i in (30, 60) else w for i, w in enumerate(words)]
    further = [f"e{i}" if i in (20, 40, 60) else w for i, w in enumerate(WORDS[200:304])]  # 85 of 115
    rows = enumerate(map(" ".join, (words, edited, WORDS[200:304], further)))
    frame = spark.createDataFrame(list(rows), "doc_id long, text string")
    assert {r.doc_id for r in corpus_pipeline.one_of_each_group(spark, frame, "").collect()} == {0, 2, 3}
