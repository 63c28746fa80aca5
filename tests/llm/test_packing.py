import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from corpus import SF, empty_documents, odd_documents, prose
from tokenizers import Tokenizer

from faultline.llm import packing, shared, tokens

ODD = ["", None, " ", "  a  b ", "x\n\n  y\t z ", "<|endoftext|> hi", "don't  we'll 123 4 \r\n", "　 q   r", "a " * 50,
       "é è", "日本 語  テスト", "🙂 🙂", "\x00 \x1f a", " \x85 b", "a ​ b", "z" * 3000]


@pytest.fixture(scope="module")
def whole():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def test_ids_equal_the_tokenizer(whole):
    texts = [*ODD, *(prose(s, 200) for s in range(40)), *ODD]
    got = []
    for i, j, ids, ends in tokens.encode_column(pa.array(texts, pa.string()), tokens.encoder()):
        got += [ids[ends[r]:ends[r + 1]].tolist() for r in range(j - i)]
    assert got == [whole.encode(t or "", add_special_tokens=False).ids for t in texts]


def test_small_table_of_kept_cuts(whole, monkeypatch):
    monkeypatch.setattr(tokens, "KEPT", 50)
    enc = tokens.Encoder(public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken"))
    texts = [prose(s, 300) for s in range(5)]
    for t in texts:
        (_, _, ids, _), = tokens.encode_column(pa.array([t]), enc)
        assert ids.tolist() == whole.encode(t, add_special_tokens=False).ids


@pytest.mark.parametrize("seed", range(6))
def test_plan_places_every_piece_once(seed):
    r = np.random.default_rng(seed)
    counts = np.zeros(1025, np.int64)
    counts[1:] = r.integers(0, [3, 50, 200, 5, 20, 1000][seed], 1024) * (r.random(1024) < [.1, 1, .5, .9, .02, 1][seed])
    if seed == 3:
        counts[300:] = 0
    plan = packing.best_plan(counts)
    spans = {}
    for s in plan.slots:
        for k in range(s.count):
            spans.setdefault(s.sequence + k // s.each, []).append((s.offset + k % s.each * s.length, s.length))
    assert len(spans) == plan.sequences
    for own in spans.values():
        end = 0
        for offset, length in sorted(own):
            assert offset == end
            end += length
        assert end <= 1024
    placed = np.zeros_like(counts)
    for s in plan.slots:
        placed[s.length] += s.count
    assert (placed == counts).all()
    least = -(-int((counts * np.arange(1025)).sum()) // 1024)
    assert plan.sequences <= max(least * 1.02, int(counts[513:].sum())) + 25


def check(rows, out, whole):
    want = []
    for i, t in rows:
        ids = whole.encode(t or "", add_special_tokens=False).ids + [2]
        cut = len(ids) % 1024 or min(len(ids), 1024)
        parts = [ids[:cut], *[ids[k:k + 1024] for k in range(cut, len(ids), 1024)]]
        start = 0
        for p, x in enumerate(parts):
            want.append((i, p, start, len(x), zlib.crc32(np.array(x, "<u4").tobytes())))
            start += len(x)
    got = out.collect()
    assert sorted(((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got), key=str) == sorted(want, key=str)
    by = {}
    for r in got:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for own in by.values():
        end = 0
        for offset, length in sorted(own):
            assert offset == end
            end += length
        assert end <= 1024
    return len(by), sum(x[3] for x in want)


def test_query(spark, whole):
    rows = [(r.doc_id, r.text) for r in shared.table(spark, SF, "documents").collect()]
    used, total = check(rows, packing.query(spark, SF), whole)
    assert used <= total / 1024 * 1.05 + 1


def test_odd_rows(spark, whole):
    docs = odd_documents(spark, [(20 + i, t) for i, t in enumerate(ODD)] + [(50, prose(50, 4000))])
    check([(r.doc_id, r.text) for r in docs.collect()], packing.stage(spark, docs, None), whole)


def test_empty_table(spark):
    assert packing.stage(spark, empty_documents(spark), None).collect() == []
