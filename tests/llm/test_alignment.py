"""Token alignment against a plain version by the libraries, and on odd input."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from headway.llm import alignment, queries

A = Tokenizer.from_file(public_tokenizers.path(queries.A_FILE))
A.encode_special_tokens = True
B = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(queries.B_FILE))
LETTERS = alignment.byte_letters()


@pytest.fixture(scope="module")
def files():
    return alignment.read_files(public_tokenizers.path(queries.A_FILE), public_tokenizers.path(queries.B_FILE))


def piece(i):
    p = B.id_to_piece(i)
    return bytes([int(p[3:5], 16)]) if B.is_byte(i) else p.replace("▁", " ").encode()


def plain(texts):
    """Per text (n_a, n_b, n_groups, n_links, n_best, count_sum, groups)."""
    docs, holders = [], Counter()
    for text in texts:
        text = text or ""
        a = A.encode(" " + text, add_special_tokens=False).ids
        b = B.encode(text)
        raw_a = [bytes(LETTERS[c] for c in A.id_to_token(i)) for i in a]
        raw_b = [piece(i) for i in b]
        if not text or b"".join(raw_a) != b" " + text.encode() or b"".join(raw_b) != b" " + text.encode():
            docs.append((0, 0, 0, [], ""))
            continue
        end = lambda raw: [sum(map(len, raw[:i + 1])) for i in range(len(raw))]
        ends_a, ends_b = end(raw_a), end(raw_b)
        links = [(i, j) for i, x, ea in zip(a, raw_a, ends_a) for j, y, eb in zip(b, raw_b, ends_b) if min(ea, eb) > max(ea - len(x), eb - len(y))]
        groups, last = [], 0
        for cut in sorted(set(ends_a) & set(ends_b)):
            own = lambda ids, ends: ",".join(str(i) for i, e in zip(ids, ends) if last < e <= cut)  # noqa: E731, B023
            groups.append(own(a, ends_a) + "|" + own(b, ends_b))
            last = cut
        docs.append((len(a), len(b), len(groups), links, ";".join(groups)))
        holders.update(set(links))
    most = defaultdict(int)
    for (a, _), n in holders.items():
        most[a] = max(most[a], n)
    return [(na, nb, ng, len(links), sum(holders[x] == most[x[0]] for x in links), sum(holders[x] for x in links), g) for na, nb, ng, links, g in docs]


def frame(spark, texts):
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")


def got(df):
    return [(r["n_a"], r["n_b"], r["n_groups"], r["n_links"], r["n_best"], r["count_sum"], r["groups"]) for r in df.orderBy("doc_id").collect()]


TEXTS = ["Hello world, it's unbelievable!", "  leading spaces and   inner  runs", "naïve café 中文字 😀 mixed", "<|endoftext|> and <s> </s> <unk> <0x41>", "▁ is a piece mark", None, "",
         "tabs\tand\nlines\r\n\n", "a", " ", "é", "supercalifragilistic antidisestablishmentarianism", "x" * 300, "1234567890 3.14159 0x1F", "Hello world, it's unbelievable!", "ﬁ ligature ½ ² Å"]


def test_against_the_libraries(spark, files):
    rng = random.Random(8)
    words = "the house of cards internationalization 2024 don't ½ naïve 中文 foo_bar(x); \t \n  ...".split(" ")
    texts = TEXTS + [" ".join(rng.choices(words, k=rng.randint(1, 40))) for _ in range(60)]
    want = plain(texts)
    assert got(alignment.align(frame(spark, texts), *files)) == want
    hashed = got(alignment.align(frame(spark, texts).repartition(3), *files, digest=True))
    assert [r[6] for r in hashed] == [hashlib.sha256(w[6].encode()).hexdigest() if w[0] else "" for w in want]


def test_stretches_have_the_ids_of_whole_texts(spark, files, monkeypatch, docs):
    monkeypatch.setattr(alignment, "CALL_CHARS", 40)
    rng = random.Random(15)
    t = alignment.Tokenizers(*files)
    assert t.seams
    odd = ["a", "é", "中", " ", "  ", "\n", "\t", "\u00a0", "\u3000", "\x1c", "\x85", "don't", "'s", "1", "½", "...", "▁", "😀", "<s>", "x y", "\r\n", "ß,", "\u0301"]
    texts = [x for x in TEXTS if x] + ["".join(rng.choices(odd, k=rng.randint(1, 12))) for _ in range(3000)] + [r["text"] for r in docs.limit(60).collect()]
    every = [p for x in texts for p in t.stretches(x)]
    together, alone = t.encode(every), [t.encode([p]) for p in every]
    assert all(np.array_equal(x, np.concatenate(y)) for x, y in zip(together, zip(*alone)))
    for text in texts:
        parts = t.stretches(text)
        assert " ".join(parts) == text
        ids = t.encode(parts)
        a, b = A.encode(" " + text, add_special_tokens=False).ids, B.encode(text)
        exact = b"".join(bytes(LETTERS[c] for c in A.id_to_token(i)) for i in a) == b" " + text.encode() == b"".join(map(piece, b))
        assert exact == ids.exact.all() and ids.n_a.sum() == len(ids.a)
        if exact:
            assert (ids.a.tolist(), ids.b.tolist()) == (a, b)


def test_small_memo(files):
    texts = [x for x in TEXTS if x] + ["some words of a longer text, 12 times or so " * 20]
    want = plain(texts)
    aligner = alignment.Aligner(alignment.Tokenizers(*files), memo_bytes=500)
    for _ in range(2):
        for text, w in zip(texts, want):
            found = aligner.find(aligner.t.stretches(text))
            if None in found:
                assert w[0] == 0
            else:
                assert (sum(s.n_a for s in found), sum(s.n_b for s in found), "".join(aligner.text[n] for s in found for n in s.windows)[:-1]) == (w[0], w[1], w[6])
                assert (sum(aligner.n_groups[n] for s in found for n in s.windows), sum(len(aligner.links[n]) for s in found for n in s.windows)) == (w[2], w[3])


def test_documents(spark, docs, files):
    texts = [r["text"] for r in docs.orderBy("doc_id").limit(40).collect()]
    assert got(alignment.align(frame(spark, [t[:1500] for t in texts]), *files)) == plain([t[:1500] for t in texts])


def test_odd_rows(spark, odd, files):
    named = odd.withColumns({c: F.lit("clash") for c in ("N_A", "groups", "portion", "pairs", "docs", "rows", "c0", "pair", "times", "best", "count")})
    out = alignment.align(named, *files)
    assert out.columns == [c for c in named.columns if c not in ("text", "N_A", "groups")] + [n for n, _ in alignment.FIELDS]
    rows = named.collect()
    short = [r["text"] if len(r["text"] or "") < 10_000 else r["text"][:60] for r in rows]
    full = {r["doc_id"]: r for r in out.where("doc_id in (6, 7)").collect()}
    assert full[6]["n_a"] == len(A.encode(" " + "word " * 30_000, add_special_tokens=False).ids)
    assert full[7]["n_b"] == len(B.encode("x" * 50_000))
    mixed = named.withColumn("text", F.when(F.length("text") < 10_000, F.col("text")).otherwise(F.substring("text", 1, 60)))
    want = sorted((str(r["doc_id"]), *w) for r, w in zip(rows, plain(short)))
    assert sorted((str(r["doc_id"]), *(r[n] for n, _ in alignment.FIELDS)) for r in alignment.align(mixed, *files).collect()) == want
    assert alignment.align(named.limit(0), *files).collect() == []
