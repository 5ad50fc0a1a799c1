"""The divergence audit against plain counting, and on odd input."""

import random
import re
from collections import Counter, defaultdict

import pyarrow as pa
from pyspark.sql import functions as F

from headway.llm import divergence, tables

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def plain(rows, min_docs=3, top=200):
    occ, docs, groups = defaultdict(Counter), defaultdict(Counter), set()
    for text, lang, source in rows:
        text, lang, source = text or "", lang or "", source or ""
        found = TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text))
        groups.add((lang, source))
        occ[lang, source].update(found)
        docs[lang].update(set(found))
    out = []
    for lang in docs.keys() | {g[0] for g in groups}:
        kept = [t for t, n in docs[lang].items() if n >= min_docs]
        names = sorted(s for x, s in groups if x == lang)
        n = {s: sum(occ[lang, s][t] for t in kept) for s in names}
        share = lambda c, total: 1 + 10**9 * (c + 1) // (total + len(kept))
        p = {s: {t: share(occ[lang, s][t], n[s]) for t in kept} for s in names}
        q = {t: share(sum(occ[lang, s][t] for s in names), sum(n.values())) for t in kept}
        for s in names:
            pairs = [(sum((p[s][t] - p[o][t]) ** 2 // p[o][t] for t in kept), o) for o in names if o != s]
            above = [((p[s][t] - q[t]) ** 2 // q[t], t) for t in kept if occ[lang, s][t] and p[s][t] > q[t]]
            for part, found in (("pair", pairs), ("term", above)):
                found.sort(key=lambda x: (-x[0], x[1].encode()))
                out += [(lang, s, part, item, value, i) for i, (value, item) in enumerate(found, 1) if part == "pair" or i <= top]
    return sorted(out)


def frame(spark, rows):
    return spark.createDataFrame(rows, "text string, lang string, source string")


def test_against_plain_counting(spark):
    rng = random.Random(5)
    words = ["a", "aé", "aéz", "abcde", "abcdef", "abcdefghij" * 3, "ñandú", "É", "Été", "naïve" * 9, "z" * 200, "Übergröße", "中文", "e1e", "x_y", "don't"] + [f"w{chr(97 + i)}" for i in range(26)]
    rows = [(" ".join(rng.choices(words, k=rng.randint(0, 12))), rng.choice(["en", "de", None, ""]), rng.choice(["s1", "s2", "S1", None, "é"])) for _ in range(150)]
    rows += [("q" * 5000 + " once", "xx", "a"), ("q" * 5000, "xx", "b"), ("q" * 5000 + " b", "xx", "c"), ("only here", "yy", "a"), (None, "yy", "b")]
    want = plain(rows)
    got = sorted(map(tuple, divergence.audit(frame(spark, rows)).collect()))
    assert got == want
    # few bits: nearly every prefix passes
    assert sorted(map(tuple, divergence.audit(frame(spark, rows).repartition(5), bits=1 << 15, first_level=1).collect())) == want


def test_thresholds(spark):
    rows = [("alpha beta", "en", "a"), ("alpha alpha gamma", "en", "b"), ("beta gamma", "en", "a"), ("alpha", "en", None)]
    for k, top in ((1, 1), (2, 200), (4, 200)):
        assert sorted(map(tuple, divergence.audit(frame(spark, rows), min_docs=k, top=top).collect())) == plain(rows, k, top)
    kept = divergence.kept_terms(frame(spark, rows), 3).select("term", "source", "n_occurrences", "lang_docs", "lang_occurrences")
    assert sorted(map(tuple, kept.collect())) == [("alpha", "", 1, 3, 4), ("alpha", "a", 1, 3, 4), ("alpha", "b", 2, 3, 4)]


def test_survivors_are_kept_as_bits(spark):
    items = spark.createDataFrame([("en", bytearray(b"abcd")), ("de", bytearray(b"\xc3\xa9x"))], "lang string, item binary")
    bits = 1 << 16
    at = F.crc32(F.concat(F.concat("lang", F.lit("\0")).cast("binary"), "item"))
    got = tables.bitmap(items, at, bits)
    on = {i for i in range(bits) if got[i >> 3] >> (i & 7) & 1}
    assert on == {divergence._bit(p, divergence.zlib.crc32(lang + b"\0"), bits) for lang, p in ((b"en", b"abcd"), (b"de", b"\xc3\xa9x"))}


def test_small_tasks_and_blocks_sum_to_the_same(monkeypatch):
    rng = random.Random(9)
    rows = [(rng.choice("xy"), rng.choice("abc"), " ".join(rng.choices(["one", "two", "three", "sixteen", "seventeen", "eighteenth"], k=rng.randint(0, 9))).encode()) for _ in range(80)]
    batch = pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows), (pa.string(), pa.string(), pa.binary()))], names=["lang", "source", "text"])

    def counted():
        out = Counter()
        for b in divergence._level_counts(0, 6, 8, None)(iter([batch.slice(0, 30), batch.slice(30)])):
            for lang, item, complete, docs, n, sources, counts in zip(*(c.to_pylist() for c in b.columns)):
                out[lang, item, complete, "docs"] += docs
                out[lang, item, complete, "n"] += n
                for s, c in zip(sources, counts):
                    out[lang, item, s] += c
        return out

    whole = counted()
    assert whole["x", b"one", True, "docs"] == sum(r[0] == "x" and b"one" in r[2].split() for r in rows)
    assert whole["y", b"sevent", False, "docs"] == sum(r[0] == "y" and b"seventeen" in r[2] for r in rows)
    monkeypatch.setattr(divergence, "TASK_ENTRIES", 3)
    assert counted() == whole

    by_source = [[{"source": s, "p": rng.randint(1, 50), "base": {"a": 3, "b": 5, "c": 2, "d": 9}[s]} for s in rng.sample("abcd", rng.randint(2, 4))] for _ in range(60)]
    kind = pa.list_(pa.struct([("source", pa.string()), ("p", pa.int64()), ("base", pa.int64())]))
    table = pa.record_batch([pa.array(["x" if i % 3 else "y" for i in range(60)]), pa.array(by_source, kind)], names=["lang", "by_source"])

    def compared():
        out = Counter()
        for b in divergence._shared_terms(iter([table.slice(0, 25), table.slice(25)])):
            for lang, source, item, common, delta in zip(*(c.to_pylist() for c in b.columns)):
                out[lang, source, item, "common"] += common
                out[lang, source, item, "delta"] += delta
        return out

    whole = compared()
    monkeypatch.setattr(divergence, "CELLS", 20)
    assert compared() == whole and whole["x", "a", "b", "common"] == sum({"a", "b"} <= {r["source"] for r in rows} for i, rows in enumerate(by_source) if i % 3)


def test_odd_rows(spark, odd):
    named = odd.withColumns({c: F.lit("clash") for c in ("term", "item", "P", "base", "N", "complete", "docs")})
    got = sorted(map(tuple, divergence.audit(named).collect()))
    assert got == plain([(r["text"], r["lang"], r["source"]) for r in odd.collect()])
    assert divergence.audit(named.limit(0)).collect() == []
    assert divergence.audit(odd.limit(0)).columns == ["lang", "source", "part", "item", "value", "rank"]
