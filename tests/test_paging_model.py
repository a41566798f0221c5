"""Whole-table paging rules vs a sequential model of the paged listing loop."""

import random

from quire import schemas
from quire.operators import wiki


def sequential(batches: dict[int, tuple[int, bool, list]], batch: int, cap):
    """Request start=0, batch, 2*batch, ... until a short, failed or missing batch; then cap."""
    pages, start = [], 0
    while True:
        if start not in batches:
            break
        status, parsed, results = batches[start]
        if not (200 <= status < 300 and parsed):
            break
        pages.extend(results)
        if cap is not None and len(pages) >= cap:
            break
        if len(results) < batch:
            break
        start += batch
    return pages if cap is None else pages[:cap]


def last_wins(pages):
    out = {}
    for p in pages:
        out[p] = p  # same name: the later one replaces the earlier
    return out


def random_source(rnd, batch):
    out = {}
    n_batches = rnd.randint(0, 6)
    for k in range(n_batches):
        if rnd.random() < 0.1:
            continue  # missing response
        r = rnd.random()
        n = batch if r < 0.6 else rnd.randint(0, batch + 2)  # full, short, empty or oversized
        status = 500 if rnd.random() < 0.1 else 200
        parsed = rnd.random() > 0.05
        out[k * batch] = (status, parsed, [f"t{rnd.randint(0, 9)}" for _ in range(n)])
    return out


def test_paging_matches_sequential_model(spark):
    rnd = random.Random(2024)
    batch = 3
    sources = {f"s{i}": random_source(rnd, batch) for i in range(60)}
    rows = []
    for sd, bs in sources.items():
        for start, (status, parsed, titles) in bs.items():
            results = [{"title": t, "body": {"storage": {"value": f"{sd}:{start}:{j}"}}, "ancestors": []}
                       for j, t in enumerate(titles)]
            rows.append((sd, start, status, parsed, results))
    df = spark.createDataFrame(rows, schemas.CONTENT_BATCHES)
    for cap in (None, 0, 1, 4, 7):
        pages = wiki.cap_pages(wiki.listed_pages(df, batch), cap)
        got = {}
        for r in pages.select("source_dir", "ordinal", "title", "body").collect():
            got.setdefault(r["source_dir"], []).append((r["ordinal"], r["title"], r["body"]))
        for sd, bs in sources.items():
            flat = [(start, j) for start in sorted(bs) for j in range(len(bs[start][2]))]
            bodies = {(s, j): f"{sd}:{s}:{j}" for s, j in flat}
            want = sequential({s: (st, pa, [bodies[(s, j)] for j in range(len(res))]) for s, (st, pa, res) in bs.items()},
                              batch, cap)
            have = [b for _, _, b in sorted(got.get(sd, []))]
            assert have == want, (sd, cap)
        # Last write wins on titles, in listing order.
        files = wiki.last_write_wins(wiki.page_files(pages))
        by = {}
        for r in files.select("source_dir", "rel_path", "ordinal").collect():
            by.setdefault(r["source_dir"], {})[r["rel_path"]] = r["ordinal"]
        for sd in sources:
            expect = {}
            for o, t, _ in sorted(got.get(sd, [])):
                expect[f"{t}.md"] = o
            assert by.get(sd, {}) == expect, (sd, cap)
