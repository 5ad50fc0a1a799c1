"""Repeated strings against a plain dictionary of windows, and on odd input."""

import random
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from headway.llm import suffix_dedup as S


def plain(texts, length=S.LENGTH, keep=None):
    """Spans of each text; texts in the order in which the first one stays."""
    places = defaultdict(list)
    for i, t in enumerate(texts):
        for s in range(len(t) - length + 1):
            places[t[s:s + length]].append((i, s))
    gone = [set() for _ in texts]
    for found in places.values():
        if len(found) > 1:
            for i, s in found if keep is None else found[1:]:
                gone[i].update(range(s, s + length))
    out = []
    for g in gone:
        marks = sorted(g)
        cuts = [k for k, m in enumerate(marks) if not k or marks[k - 1] != m - 1]
        out.append([(marks[a], marks[b - 1] + 1) for a, b in zip(cuts, [*cuts[1:], len(marks)])])
    return out


def corpus(seed, n, length=S.LENGTH):
    """Texts with exact and near copies, passages at odd places, edits, periodic runs and other scripts."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choices("abcdeé中", k=rng.randint(1, 9)))
    prose = lambda k: " ".join(word() for _ in range(k))
    passages = [prose(rng.randint(20, 90)) for _ in range(6)]
    out = []
    while len(out) < n:
        kind = rng.random()
        if out and kind < 0.15:
            out.append(rng.choice(out))
        elif out and kind < 0.4:
            t = list(rng.choice(out))
            for _ in range(rng.randint(1, 4)):
                if t:
                    t[rng.randrange(len(t))] = rng.choice("xyz ")
            out.append("".join(t))
        elif kind < 0.75:
            out.append(prose(rng.randint(0, 30)) + rng.choice(passages)[rng.randint(0, 20):] + prose(rng.randint(0, 20)) + rng.choice(passages))
        elif kind < 0.8:
            out.append(rng.choice(["ab", "=", "xyz-", " "]) * rng.randint(1, 400) + prose(5))
        else:
            out.append(prose(rng.randint(0, 200)))
    return out


def frame(spark, texts):
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")


def spans(df):
    return [[tuple(s) for s in r["spans"]] for r in df.orderBy("doc_id").collect()]


def test_anchors_are_chosen_by_content():
    raw = [t.encode() for t in corpus(1, 40) if len(t.encode()) >= S.LENGTH]
    x = S.anchors(raw)
    by_window = defaultdict(set)
    for p, s, n, lead, a in zip(x.part, x.start, x.windows, x.lead, x.anchor):
        for j in range(n):
            at = s + lead
            assert s + j <= at <= s + j + S.LENGTH - S.GRAM
            by_window[raw[p][s + j:s + j + S.LENGTH]].add((at - s - j, a))
    assert all(len(v) == 1 for v in by_window.values())
    assert sum(x.windows) == sum(len(t) - S.LENGTH + 1 for t in raw)


def test_previous_and_next_smaller_positions():
    rng = np.random.default_rng(2)
    for _ in range(200):
        n = int(rng.integers(1, 30))
        pos, joined = rng.permutation(n), rng.random(n - 1) < 0.7
        psv, nsv = S.previous_factors(pos, joined)
        for i in range(n):
            lo = next((j for j in range(i - 1, -1, -1) if pos[j] < pos[i]), -1)
            hi = next((j for j in range(i + 1, n) if pos[j] < pos[i]), -1)
            assert psv[i] == (lo if lo >= 0 and joined[lo:i].all() else -1)
            assert nsv[i] == (hi if hi >= 0 and joined[i:hi].all() else -1)


@pytest.mark.parametrize("keep", [None, "first"])
def test_against_all_windows(spark, keep):
    for seed in (3, 4):
        texts = corpus(seed, 120)
        df = frame(spark, texts)
        want = plain([t.encode() for t in texts], keep=keep)
        assert sum(map(len, want)) > 40
        assert spans(S.dedup(df, keep=keep)) == want


def test_fingerprints_lengths_and_few_bits(spark):
    texts = corpus(5, 90)
    want = plain([t.encode() for t in texts])
    df = frame(spark, texts).repartition(7)
    assert spans(S.dedup(df, keep=None, bits=1 << 15)) == want      # most bits are on
    assert spans(S.dedup(df, keep=None, sorted_contexts=1)) == want     # every anchor with several contexts by fingerprints
    assert spans(S.dedup(df, length=61, keep=None)) == plain([t.encode() for t in texts], 61)


def test_pieces_deal_every_window_once(monkeypatch):
    monkeypatch.setattr(S, "PIECE", 777)
    texts = [t.encode() for t in corpus(7, 60)] + [bytes(i % 251 for i in range(5000))]
    batch = pa.record_batch([pa.array(range(len(texts)), pa.int64()), pa.array(range(len(texts)), pa.int64()), pa.array(texts, pa.binary())], names=["doc", "k", "text"])
    lists = list(S._pieces(batch, S.LENGTH))
    assert all(sum(len(p[3]) for p in x) <= 777 for x in lists)
    found = sorted((doc, at + j, raw[j:j + S.LENGTH]) for x in lists for doc, _, at, raw in x for j in range(len(raw) - S.LENGTH + 1))
    assert found == [(i, s, t[s:s + S.LENGTH]) for i, t in enumerate(texts) for s in range(len(t) - S.LENGTH + 1)]


def test_batches_of_whole_anchors(monkeypatch):
    texts = [t.encode() for t in corpus(8, 60) if len(t.encode()) >= S.LENGTH]
    rows = []
    for i, raw in enumerate(texts):
        x = S.anchors([raw])
        rows += [(int(a.view(np.int64)), 0, i, 0, int(s), int(n), int(d), 1, raw[s:s + n + S.LENGTH - 1]) for a, s, n, d in zip(x.anchor, x.start, x.windows, x.lead)]
    rows.sort(key=lambda r: r[0])
    kinds = [pa.int64()] * 4 + [pa.int32()] * 4 + [pa.binary()]
    batch = pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=[*S.OCCURRENCES.replace(" long", "").replace(" int", "").split(", "), "bytes"])
    solved = lambda: sorted(r for b in S._sorted_contexts(S.LENGTH)(iter([batch])) for r in zip(*(c.to_pylist() for c in b.columns)))
    whole = solved()
    places = defaultdict(list)
    for i, t in enumerate(texts):
        for s in range(len(t) - S.LENGTH + 1):
            places[t[s:s + S.LENGTH]].append((i, s))
    found = {(d, s + j, late) for d, _, s, n, late in whole for j in range(n)}
    assert found == {(*p, k > 0) for at in places.values() if len(at) > 1 for k, p in enumerate(at)}
    monkeypatch.setattr(S, "BATCH_CONTEXTS", 4)
    assert solved() == whole


def test_one_passage_in_many_documents(spark):
    rng = random.Random(6)
    word = lambda: "".join(rng.choices("abcdefgh", k=5))
    passage = " ".join(word() for _ in range(55))
    texts = [" ".join(word() for _ in range(rng.randint(5, 40))) + passage + " ".join(word() for _ in range(30)) for _ in range(300)]
    want = plain([t.encode() for t in texts])
    assert spans(S.dedup(frame(spark, texts), keep=None)) == want
    assert spans(S.dedup(frame(spark, texts), keep=None, sorted_contexts=50)) == want
    assert spans(S.dedup(frame(spark, texts), sorted_contexts=50)) == plain([t.encode() for t in texts], keep="first")


def test_odd_rows(spark, odd):
    named = odd.withColumns({c: F.lit("clash") for c in ("SPANS", "doc", "k", "start", "anchor", "context", "found", "row", "windows")}).drop("spans")
    got = S.dedup(named, keep=None)
    assert sorted(c for c in got.columns if c != "spans") == sorted(c for c in named.columns if c != "SPANS")
    texts = [(r["text"] or "").encode() for r in named.collect()]
    want = plain([t[:3000] if t[:1] == b"x" else t for t in texts])      # the 50,000 x are long for the plain version
    size = lambda t, w: [(0, len(t))] if t[:1] == b"x" else w
    expect = sorted((t, size(t, w)) for t, w in zip(texts, want))
    assert sorted(((r["text"] or "").encode(), [tuple(s) for s in r["spans"]]) for r in got.collect()) == expect
    assert S.dedup(named.limit(0)).collect() == [] and S.dedup(frame(spark, ["", "a"])).select("spans").collect() == [([],), ([],)]
    with pytest.raises(ValueError):
        S.dedup(named, length=20)


def test_query_digests(spark, docs):
    from headway.llm import queries
    import hashlib
    got = queries.op12_suffix_dedup(spark, "/root/testdata/sf0.001").orderBy("doc_id").collect()
    texts = [(r["text"] or "").encode() for r in docs.orderBy("doc_id").collect()]
    for r, t, w in zip(got, texts, plain(texts)):
        kept = S.kept_bytes(t, w)
        assert tuple(r)[1:] == (len(t), len(t) - len(kept), len(w), hashlib.sha256(kept).hexdigest())


def test_anchors_stay_whole_where_joins_are_split(spark):
    """A join of the contexts whose tasks adaptive execution splits must not split an anchor's contexts."""
    rng = random.Random(5)
    noise = lambda k: "".join(rng.choices("abcdefgh ", k=k))
    passages = [noise(300), noise(300)]
    texts = [noise(rng.randint(0, 120)) + p[rng.randint(0, 60):] + noise(rng.randint(0, 120)) for p, k in zip(passages, (500, 1500)) for _ in range(k)]
    want = plain([t.encode() for t in texts])
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10KB", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1"}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        got = {r.doc_id: [tuple(x) for x in r.spans] for r in S.dedup(frame(spark, texts), keep=None, sorted_contexts=1000).collect()}
    finally:
        for k in conf:
            spark.conf.unset(k)
    assert [got[i] for i in range(len(texts))] == want
