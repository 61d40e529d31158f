import re
from collections import Counter, defaultdict

import pytest
from cases import awkward, clashing, empty, rows_of

from sensoria.llm import divergence

PATTERN = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def brute(rows, min_docs, top):
    """rows: text, lang, source."""
    counts, docs, groups = defaultdict(Counter), defaultdict(Counter), set()
    for text, lang, source in rows:
        lang, source = lang or "", source or ""
        groups.add((lang, source))
        found = PATTERN.findall((text or "").translate(LOWER))
        counts[lang, source].update(found)
        docs[lang].update(set(found))
    out = []
    for lang in {lang for lang, _ in groups}:
        terms = [term for term, n in docs[lang].items() if n >= min_docs]
        sources = sorted(source for other, source in groups if other == lang)

        def shares(held, terms=terms):
            size = sum(held[term] for term in terms)
            return {term: 1 + 10**9 * (held[term] + 2) // (size + 2 * len(terms)) for term in terms}

        total = Counter()
        for source in sources:
            total.update(counts[lang, source])
        own, p = shares(total), {source: shares(counts[lang, source]) for source in sources}
        differ = lambda a, b: (a - b) ** 2 // (a + b)
        for source in sources:
            pairs = [(sum(differ(p[source][t], p[o][t]) for t in terms), o) for o in sources if o != source]
            best = [
                (differ(p[source][t], own[t]), t) for t in terms if counts[lang, source][t] and p[source][t] > own[t]
            ]
            for part, found, limit in (("pair", pairs, None), ("term", best, top)):
                found.sort(key=lambda x: (-x[0], x[1].encode()))
                out += [(lang, source, part, item, v, i) for i, (v, item) in enumerate(found[:limit], 1)]
    return sorted(out, key=repr)


@pytest.mark.parametrize("block", [1, 2, 64])
def test_awkward_rows(spark, block):
    s = divergence.Settings(min_docs=2, top=3, block=block, held_terms=5, chunk_rows=7)
    docs = clashing(awkward(spark))
    rows = [(r.text, r.lang, r.source) for r in awkward(spark).collect()]
    assert rows_of(divergence.audit(docs, s)) == brute(rows, 2, 3)


def test_whole_table(spark):
    folder = "/root/testdata/sf0.01"
    rows = [(r.text, r.lang, r.source) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    assert rows_of(divergence.op12_divergence(spark, folder)) == brute(rows, 10, 10)


def test_many_sources_in_blocks(spark):
    rows = [(f"common w{i % 7} w{i * i % 11} only{i % 90}", "x", f"s{i % 90:02}") for i in range(900)]
    docs = spark.createDataFrame(rows, "text string, lang string, source string")
    s = divergence.Settings(min_docs=5, block=16)
    assert rows_of(divergence.audit(docs, s)) == brute(rows, 5, 10)


def test_no_kept_terms_and_empty(spark):
    rows = [("a b", None, "p"), (None, None, "q"), ("", "", None)]
    docs = spark.createDataFrame(rows, "text string, lang string, source string")
    found = rows_of(divergence.audit(docs))
    assert found == brute(rows, 10, 10) and len(found) == 6 and {r[4] for r in found} == {0}
    assert divergence.audit(empty(spark)).count() == 0


def test_shares_beyond_64_bits(spark):
    from pyspark.sql import functions as F

    n, size, terms = 3 * 10**12, 9 * 10**13, 10**7
    row = spark.range(1).select(
        divergence.share(F.lit(n), F.lit(size), F.lit(terms)).alias("p"),
        divergence.share(F.lit(0).cast("long"), F.lit(0).cast("long"), F.lit(0).cast("long")).alias("none"),
    ).first()
    assert row.p == 1 + 10**9 * (n + 2) // (size + 2 * terms) and row.none == 0
