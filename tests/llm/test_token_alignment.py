"""Token alignment against a brute-force version that compares every A token with every B token."""

import hashlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

public_tokenizers = pytest.importorskip("public_tokenizers")

from threadlens.llm import token_alignment  # noqa: E402

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
TEXTS = [
    "The quick brown fox's jump", "The quick brown fox", "", None, "naïve café 東京 😀 x", "a  b\n\n c\t", "<|endoftext|> <s> </s>", " lead",
    "one ▁ mark", "The quick brown fox", "zero\0byte", "x" * 300, "é <0x41> ﬁ", "\r\n", " ",
]


def brute(texts):
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=B)
    spelled = {v: k for k, v in token_alignment.byte_level_alphabet().items()}
    letters = {c: x for x, c in spelled.items()}
    links, out = [], []
    for text in texts:
        ids_a = a.encode(" " + text, add_special_tokens=False).ids if text else []
        ids_b = b.encode(text) if text else []
        raw_a = [bytes(letters[c] for c in a.id_to_token(i)) for i in ids_a]
        raw_b = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in ids_b]
        if text and (b"".join(raw_a) != (" " + text).encode() or b"".join(raw_b) != (" " + text).encode()):
            ids_a, ids_b, raw_a, raw_b = [], [], [], []

        def spans(raw):
            at = 0
            for x in raw:
                yield at, at + len(x)
                at += len(x)

        span_a, span_b = list(spans(raw_a)), list(spans(raw_b))
        linked = [(ids_a[i], ids_b[j]) for i, x in enumerate(span_a) for j, y in enumerate(span_b) if x[0] < y[1] and y[0] < x[1]]
        cuts = sorted({y for _, y in span_a} & {y for _, y in span_b})
        groups, low = [], 0
        for cut in cuts:
            parts = [",".join(str(i) for i, (x, y) in zip(ids, span) if low <= x and y <= cut) for ids, span in ((ids_a, span_a), (ids_b, span_b))]
            groups.append("|".join(parts))
            low = cut
        links.append(linked)
        out.append([len(ids_a), len(ids_b), len(groups), len(linked), ";".join(groups)])
    held = Counter(p for linked in links for p in set(linked))
    best = Counter()
    for (x, _), n in held.items():
        best[x] = max(best[x], n)
    rows = []
    for linked, (na, nb, ng, nl, groups) in zip(links, out):
        digest = hashlib.sha256(groups.encode()).hexdigest() if na else ""
        rows.append((na, nb, ng, nl, sum(held[p] == best[p[0]] for p in linked), sum(held[p] for p in linked), digest, groups))
    return rows


def aligned(spark, texts, detail=True):
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, groups string")
    rows = token_alignment.align_documents(docs.repartition(3), A, B, detail).orderBy("doc_id").collect()
    assert [r[0] for r in rows] == list(range(len(texts)))
    return [tuple(r)[1:] for r in rows]


def test_equals_brute_force(spark):
    assert aligned(spark, TEXTS) == brute(TEXTS)


def test_chunks_and_cuts_do_not_matter(spark, monkeypatch):
    texts = [t * 40 if t else t for t in TEXTS] + ["The quick brown fox's 12 jumps " * 60]
    pair = token_alignment.Pair(open(A, encoding="utf-8").read(), open(B, "rb").read())
    assert pair.cuts
    monkeypatch.setattr(token_alignment, "PART_CHARS", 20)
    monkeypatch.setattr(token_alignment, "SORTED_CHARS", 200)
    whole = brute(texts)
    assert len(list(pair.parts(texts[-1]))) > 5
    chunk = token_alignment.Chunk(pair, texts, True)
    assert [b"".join(t).decode() if x and n else "" for t, x, n in zip(chunk.texts, chunk.whole, chunk.n_a)] == [r[-1] for r in whole]
    assert [int(n) if x else 0 for n, x in zip(chunk.n_links, chunk.whole)] == [r[3] for r in whole]


def test_whole_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(60)
    texts = [r[0] for r in docs.orderBy("doc_id").select(F.substring("text", 1, 1500)).collect()]
    assert [r[:-1] for r in brute(texts)] == aligned(spark, texts, detail=False)


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert token_alignment.align_documents(docs, A, B).collect() == []


def test_ranks_encode_as_the_file_does(spark):
    pair = token_alignment.Pair(open(A, encoding="utf-8").read(), open(B, "rb").read())
    assert pair.by_rank is not None
    texts = [r[0] for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("text").collect()]
    texts += [chr(c) + "a" + chr(c) + " 1" + chr(c) * 2 + "\n" for c in [9, 10, 13, *range(32, 127), *range(0xA1, 0x180)]]
    ids, _ = pair.encode(texts)
    assert ids == [e.ids for e in pair.a.encode_batch([" " + t for t in texts], add_special_tokens=False)]
    broken = open(A, encoding="utf-8").read().replace('"dropout": null', '"dropout": 0.1').replace('"dropout":null', '"dropout":0.1')
    assert token_alignment.rank_encoder(broken, token_alignment.byte_level_alphabet()) is None
