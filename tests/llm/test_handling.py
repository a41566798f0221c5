"""Names that operators use inside, hot null ids, empty tables, and counts against plain Python."""

import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from quire.llm import common, hashtables, kneserney, language, mixing, packing, quality, repetition, simhash, tokencounts

INSIDE = ["__row", "__copy", "__copies", "__text", "__n_words", "__score", "__kept", "stat_words", "rank", "block", "row", "doc", "key", "copies", "copy", "_part", "_pos", "_at", "_tie", "_order", "_s", "_held", "held", "hash", "odd`name", "a.b"]


@pytest.fixture(scope="module")
def clashing(spark):
    rows = [(i, f"the quick brown fox number {i % 7} jumps over {'many ' * (i % 5)} lazy dogs of town " * 8, "ab"[i % 2], *[f"{i}"] * len(INSIDE)) for i in range(12)]
    schema = ", ".join(["doc_id long", "text string", "source string", *(f"`{c.replace('`', '``')}` string" for c in INSIDE)])
    return spark.createDataFrame(rows, schema)


def test_names_used_inside(spark, clashing):
    labels = spark.createDataFrame([(i, 1) for i in range(12)], "doc_id long, quality int")
    rows = {r.doc_id: tuple(r) for r in clashing.collect()}
    for got in (quality.filter_documents(clashing, labels), repetition.filter_documents(clashing), simhash.keep_one(clashing), mixing.mixed_documents(clashing)):
        assert got.columns == clashing.columns
        assert all(tuple(r) == rows[r.doc_id] for r in got.collect())
    assert mixing.mixed_documents(clashing).count() > 0
    pieces = spark.createDataFrame([(i, 0, 5 + i % 3, f"r{i}", f"b{i}") for i in range(40)], "doc_id long, piece int, length long, rank string, block string")
    got = packing.pack(pieces, 16).collect()
    assert sorted((r.doc_id, r["rank"], r.block) for r in got) == sorted((i, f"r{i}", f"b{i}") for i in range(40))


def test_equal_keys_span_ranges(spark):
    """A third of the rows under a null id, and all rows alike: no range holds a quarter."""
    df = spark.range(3000).select(F.when(F.col("id") % 3 > 0, F.col("id")).alias("k"), F.lit("x").alias("c")).repartition(8)
    conf = {"spark.sql.shuffle.partitions": "8", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        for keys in (["k"], ["c"]):
            got = common.ranked(df, keys, "test").groupBy("_part").count().collect()
            assert max(r["count"] for r in got) < 750
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_empty_tables(spark, empty):
    labels = spark.createDataFrame([], "doc_id long, quality int")
    assert quality.with_score(empty, labels, ["doc_id"]).count() == 0 and quality.filter_documents(empty, labels).count() == 0
    assert language.predict(empty, None, ["doc_id"]).count() == 0
    assert kneserney.score(empty, kneserney.train(empty), ["doc_id"]).count() == 0
    assert mixing.mixed_documents(empty).count() == 0 and simhash.keep_one(empty).count() == 0


def test_a_bucket_that_cannot_be_read(spark, monkeypatch):
    df = spark.createDataFrame([(1 << 62, 5), (3, 7)], "key long, n long")
    path = hashtables.write_table(df, ["n"], 4, "test-table")
    ref = hashtables.TableRef(spark, path, 4, 1)
    assert ref.lookup(np.array([2, 3, 1 << 62], np.uint64)).tolist() == [[0, 7, 5]]
    assert ref.lookup(np.array([9 << 60], np.uint64)).tolist() == [[0]]  # a bucket without keys
    ref.root += "-gone"
    with pytest.raises(FileNotFoundError):
        ref.lookup(np.array([3], np.uint64))


def test_keys_with_low_parts(spark):
    """Keys that share 64 bits are told apart by 32 more."""
    rng = np.random.default_rng(6)
    rows = [(int(k), int(l), int(n)) for k, l, n in zip(rng.choice([-5, 0, 7, 1 << 62], 300), rng.integers(-40, 40, 300), rng.integers(1, 9, 300), strict=True)]
    want = Counter()
    for k, l, n in rows:
        want[k, l] += n
    path = hashtables.write_table(spark.createDataFrame(rows, "key long, low int, n long").repartition(3), ["n"], 4, "low-table")
    ref = hashtables.TableRef(spark, path, 4, 1)
    ask = sorted({*want, (7, 99), (8, 0), (-6, 1)}, key=lambda x: (x[0] % 2**64, x[1] % 2**32))
    got = ref.lookup(np.array([k for k, _ in ask], np.int64).view(np.uint64), np.array([l for _, l in ask], np.int32).view(np.uint32))
    assert got[0].tolist() == [want[x] for x in ask]


def test_places_that_do_not_fit(spark, odd, monkeypatch):
    import public_tokenizers

    monkeypatch.setattr(tokencounts, "NUMBER_BITS", 3)
    with pytest.raises(Exception, match="fit its bits"):
        tokencounts.count_tokens(odd, public_tokenizers.path("byte_bpe_50k.json")).count()


def fold(text):
    return " " + "".join(c if ord(c) > 127 or c.isalpha() else " " for c in text.lower()) + "  "


def four_grams(text):
    b = fold(text).encode()
    return [b[i : i + 4] for i in range(len(b) - 3) if b[i : i + 4] != b"    "]


def test_language_masks(spark, monkeypatch):
    """Every training n-gram has its languages' bits; others have them as seldom as false positives come; shares decide."""
    texts = {"en": ["the stone house", "River of stone"], "de": ["das haus der Straße"], "fr": ["la maison à l'été"], **{f"x{i:02}": [f"lang{i} word{i * i}"] for i in range(70)}}
    model = language.learn(spark.createDataFrame([(k, t) for k, ts in texts.items() for t in ts], "lang string, text string"))
    assert len(model.languages) == 73 and model.rows.shape[1] == 2
    held = {k: {g for t in ts for g in four_grams(t)} for k, ts in texts.items()}
    every = sorted(set().union(*held.values()))
    masks = model.masks(np.array([int.from_bytes(g, "little") for g in every], np.uint32))
    has = lambda m, i: bool(int(m[i // 64]) >> (i % 64) & 1)
    wrong = 0
    for g, m in zip(every, masks, strict=True):
        for i, lang in enumerate(model.languages):
            assert has(m, i) or g not in held[lang]
            wrong += has(m, i) and g not in held[lang]
    assert wrong <= 0.02 * len(every) * len(model.languages)
    for text in ("der Stone River", "à la maison lang7"):
        own = four_grams(text)
        m = model.masks(np.array([int.from_bytes(g, "little") for g in own], np.uint32))
        est = [max(np.mean([has(x, i) for x in m]) - model.false[i], 0) / (1 - model.false[i]) for i in range(73)]
        names, score = model.score(pa.array([text]))
        assert names == [model.languages[int(np.argmax(est))]] and abs(score[0] - max(est) / sum(est)) < 1e-9
    monkeypatch.setattr(language, "MAX_BITS", 10)  # a filter that is too small still misses nothing
    small = language.learn(spark.createDataFrame([(k, t) for k, ts in texts.items() for t in ts], "lang string, text string"))
    assert all(has(m, small.languages.index("en")) for m in small.masks(np.array([int.from_bytes(g, "little") for g in held["en"]], np.uint32)))


WORD = re.compile(r"[^\x20\x09-\x0D]+")


def test_repetition_counts(spark, odd):
    """Characters inside duplicated n-grams and lines, and the verdict, in plain Python."""
    base = "one two three four five six seven eight nine ten eleven twelve "
    texts = [base * 6, base * 2 + " ".join(f"u{i}" for i in range(200)), "\n".join(["same line here"] * 40 + [f"line {i} of its own" for i in range(30)]), "é ü " * 60, " ".join(f"w{i}" for i in range(300)), None]
    df = odd.select("doc_id", "text").union(spark.createDataFrame([(100 + i, t) for i, t in enumerate(texts)], "doc_id long, text string"))
    kept = 0
    for r in repetition.repetition(df, ["doc_id", "text"]).collect():
        text = r.text or ""
        words = WORD.findall(text)
        for n in repetition.MAX_NGRAM_SHARE:
            seen = Counter(tuple(words[i : i + n]) for i in range(len(words) - n + 1))
            inside = {i + k for i in range(len(words) - n + 1) if seen[tuple(words[i : i + n])] > 1 for k in range(n)}
            assert r[f"__dup_{n}gram_chars"] == sum(len(words[i]) for i in inside)
        lines, again = set(), 0
        for line in text.split("\n"):
            if WORD.search(line):
                again += len(line) if line in lines else 0
                lines.add(line)
        assert (r["__dup_line_chars"], r["__text_chars"]) == (again, len(text))
        sound = again <= 0.30 * len(text) and all(r[f"__dup_{n}gram_chars"] <= most * sum(map(len, words)) for n, most in repetition.MAX_NGRAM_SHARE.items())
        assert r["__kept"] == (sound and not r["__base_failed"])
        kept += r["__kept"]
    assert kept >= 1
