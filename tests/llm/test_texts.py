"""Quality rules, language ID, classifier, LM scores and mixing against brute force."""

import collections
import math
import re

import pytest

from quire.llm import kneserney, language, mixing, quality, repetition

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def brute_rules(text):
    text = text or ""
    w = WORD.findall(text)
    seen = collections.Counter(zip(w, w[1:], w[2:], strict=False))
    inside = {i + k for i in range(len(w) - 2) if seen[tuple(w[i : i + 3])] > 1 for k in range(3)}
    lines, again = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            again += line in lines
            lines.add(line)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), again, len(inside)


def test_quality_rules(odd, empty):
    for r in repetition.repetition(odd, odd.columns).collect():
        n, _, _, _, rep = want = brute_rules(r.text)
        assert (r["__n_words"], r["__word_chars"], r["__n_symbols"], r["__n_dup_lines"], r["__n_repeat_words"]) == want
        assert r["__base_failed"] == (n < 50 or 100 * rep > 50 * n) and (not r["__kept"] or not r["__base_failed"])
    assert repetition.filter_documents(empty).count() == 0


def test_language(spark, odd, empty):
    words = {"en": "the house and river of stone", "de": "das haus und der fluss aus stein", "xx": "zzyy qqww kkjj"}
    rows = [(lang, f"{text} {i} {text}") for lang, text in words.items() for i in range(8)]
    model = language.learn(spark.createDataFrame(rows, "lang string, text string"))
    got = {r.doc_id: r for r in language.predict(spark.createDataFrame([(0, "stone house"), (1, "der fluss und"), (2, "QQWW kkjj"), (3, None), (4, "12 !?"), (5, "")], "doc_id int, text string"), model, ["doc_id"]).collect()}
    assert [got[i].lang_pred for i in range(6)] == ["en", "de", "xx", "und", "und", "und"]
    assert all(0 <= r.score <= 1 for r in got.values())
    assert language.predict(odd, model, ["doc_id"]).count() == odd.count()
    assert language.learn(empty) is None
    assert {r.lang_pred for r in language.predict(odd, None, ["doc_id"]).collect()} == {"und"}


def test_classifier_without_and_with_labels(spark, odd):
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert {r["__score"] for r in quality.with_score(odd, none, ["doc_id"]).collect()} == {0.5}
    ones = spark.createDataFrame([(i, 1) for i in range(11)], "doc_id long, quality int")
    assert quality.filter_documents(odd, ones).count() == odd.count()


def test_classifier_held_out(spark):
    sf = "/root/testdata/sf0.01"
    got = quality.op3_quality_classifier(spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").where("held_out")
    assert got.where("predicted = quality").count() >= 0.97 * got.count()


def test_language_held_out(spark):
    sf = "/root/testdata/sf0.01"
    got = language.op6_language_id(spark, sf).join(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang"), "doc_id").where("held_out AND lang IS NOT NULL")
    assert got.where("lang = lang_pred").count() >= 0.98 * got.count()


def test_kneser_ney(odd, empty):
    train = odd.where("doc_id < 8 OR doc_id IS NULL")
    got = kneserney.score(odd, kneserney.train(train), ["doc_id", "text"]).collect()
    seqs = [[*WORD.findall((r.text or "").translate(LOWER)), "</s>"] for r in train.collect()]
    c = collections.Counter(w for s in seqs for w in s)
    n, v = sum(c.values()), len(c)
    pairs = collections.Counter(x for s in seqs for x in zip(["<s>", *s], s, strict=False))
    follows = collections.Counter(b for _, b in pairs)
    d2, d1 = (kneserney.Discounts.of([sum(x == k for x in t.values()) for k in (1, 2, 3, 4)]) for t in (pairs, follows))
    cut = lambda d, k: 0 if not k else (d.one, d.two, d.more)[min(k, 3) - 1]
    floor = sum(cut(d1, x) for x in follows.values()) / len(pairs)

    def p(a, b):
        low = (follows[b] - cut(d1, follows[b])) / len(pairs) + floor / (v + 1)
        own = [x for (f, _), x in pairs.items() if f == a]
        return ((pairs[a, b] - cut(d2, pairs[a, b])) + sum(cut(d2, x) for x in own) * low) / sum(own) if own else low

    for r in got:
        s = [*WORD.findall((r.text or "").translate(LOWER)), "</s>"]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(s), sum(w in c for w in s), n)
        assert r.base_score == pytest.approx(sum(math.log10((c[w] + 0.5) / (n + 0.5 * (v + 1))) for w in s))
        assert r.score == pytest.approx(sum(math.log10(p(a, b)) for a, b in zip(["<s>", *s], s, strict=False)))
    assert sum(p("the", w) for w in c) + sum(cut(d2, x) for (f, _), x in pairs.items() if f == "the") / sum(x for (f, _), x in pairs.items() if f == "the") * floor / (v + 1) == pytest.approx(1)
    assert {r.score for r in kneserney.score(odd, kneserney.train(empty), ["doc_id"]).collect()} == {0.0}


def fill(sizes):
    """Targets by repeated resharing."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: i % 3 + 1 for i, s in enumerate(names)}
    total, out, free = sum(sizes.values()), {}, set(names)
    while free:
        left, w = total - sum(out.values()), sum(weight[s] for s in free)
        above = {s for s in free if left * weight[s] / w > 3 * sizes[s]}
        out |= {s: 3.0 * sizes[s] for s in above} if above else {s: left * weight[s] / w for s in free}
        free -= above or free
    return out


def test_mixing(spark, odd, empty):
    docs = odd.select("doc_id", "source", mixing.words_in("text").alias("size"))
    rows = docs.collect()
    sizes = collections.Counter()
    for r in rows:
        sizes[r.source] += r.size
    want, taken = fill(sizes), collections.Counter()
    got = mixing.mix(docs).collect()
    assert len(got) == len(rows)
    for r in got:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(want[r.source]) and 0 <= r.taken <= 3 * r.size
        taken[r.source] += r.taken
    assert all(abs(taken[s] - want[s]) <= 0.5 for s in sizes)
    assert mixing.mix(empty.select("doc_id", "source", mixing.words_in("text").alias("size"))).count() == 0
    assert mixing.mixed_documents(odd).columns == odd.columns
