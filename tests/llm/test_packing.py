"""Operator 3: exact tokens, gapless sequences, packing against item-by-item best fit."""

from __future__ import annotations

import random
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from errscope.llm import settings
from errscope.llm.best_fit_packing import CapacityTree, best_fit_packing, plan, sequences
from errscope.llm.token_cache import TokenCache


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(settings.packing_tokenizer())


def _want(tokenizer, rows, capacity=2048):
    out = set()
    for i, text in rows:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [0]
        for k in range(0, len(ids), capacity):
            part = ids[k : k + capacity]
            out.add((i, k // capacity, k, len(part), zlib.crc32(np.array(part, "<u4").tobytes())))
    return out


def _check_bins(rows, capacity=2048):
    bins = defaultdict(list)
    for r in rows:
        bins[r.sequence_id].append((r.offset, r.length))
    for parts in bins.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(bins)


def test_pieces_and_sequences(docs, tokenizer):
    rows = best_fit_packing(docs, settings.packing_tokenizer()).collect()
    assert {(r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows} == _want(tokenizer, [(r.doc_id, r.text) for r in docs.collect()])
    total = sum(r.length for r in rows)
    assert _check_bins(rows) <= max(-(-total // 2048) + 1, sum(r.length > 1024 for r in rows))


def test_sequences_hold_the_tokens(spark, tokenizer):
    texts = ["a few words here", "some more words, and even more.", "x"]
    packed = best_fit_packing(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), settings.packing_tokenizer(), capacity=8, with_ids=True).persist()
    at = {(r.sequence_id): r.ids for r in sequences(packed).collect()}
    for r in packed.collect():
        ids = tokenizer.encode(texts[r.doc_id], add_special_tokens=False).ids + [0]
        assert at[r.sequence_id][r.offset : r.offset + r.length] == ids[r.start : r.start + r.length]
    _check_bins(packed.collect(), 8)


def test_token_cache_matches_tokenizer(tokenizer):
    rng = random.Random(4)
    alphabet = ["a", "B", "é", "É", "ß", "日", "́", "'", "'s", "'LL", ".", ",", "..", "1", "23", " ", "  ", "\n", "\t", " ", " ", "<|endoftext|>", "<|ENDOFTEXT|>", "<|", "Σ", "İ", "ªº", "-", "😀", "word", "Word,"]
    texts = ["".join(rng.choices(alphabet, k=rng.randint(0, 30))) for _ in range(600)] + ["", "end.", "x" * 5000]
    for entries in (50, 100_000):
        cache = TokenCache(settings.packing_tokenizer(), entries)
        got = [ids[a:b].tolist() for _, ids, bounds in cache.encode(pa.array(texts)) for a, b in zip(bounds, bounds[1:])]
        want = [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
        assert [(t, g) for t, g in zip(texts, got)] == list(zip(texts, want))
    # without the texts that hold "<|", whose slices are encoded whole
    plain = [t for t in texts if "<|" not in t]
    cache = TokenCache(settings.packing_tokenizer(), 50)
    got = [ids[a:b].tolist() for _, ids, bounds in cache.encode(pa.array(plain)) for a, b in zip(bounds, bounds[1:])]
    for t, g in zip(plain, got):
        assert g == tokenizer.encode(t, add_special_tokens=False).ids, repr(t)


def _item_by_item(lengths, capacity):
    left = []
    for n in sorted(lengths, reverse=True):
        fit = [i for i, r in enumerate(left) if r >= n]
        if fit:
            i = min(fit, key=lambda i: left[i])
            left[i] -= n
        else:
            left.append(capacity - n)
    return sorted(left)


def test_plan_equals_best_fit_decreasing():
    rng = random.Random(2)
    for capacity in (10, 64, 100):
        for _ in range(40):
            lengths = [rng.randint(1, capacity if rng.random() < 0.3 else capacity // 3) for _ in range(rng.randint(0, 200))]
            histogram = {n: lengths.count(n) for n in set(lengths)}
            flows = plan(histogram, capacity)
            used, count = defaultdict(int), defaultdict(int)
            for f in flows:
                count[f.length] += f.each * f.bins
                for b in range(f.bin, f.bin + f.bins):
                    assert used[b] == f.offset
                    used[b] += f.each * f.length
            assert dict(count) == histogram
            assert sorted(capacity - u for u in used.values()) == _item_by_item(lengths, capacity)


def test_plan_does_not_grow_with_the_corpus():
    flows = [len(plan({n: 1000 * k + n for n in range(1, 2049)}, 2048)) for k in (1, 1000, 1_000_000)]
    assert max(flows) < 100_000 and max(flows) < 1.2 * min(flows) + 2000


def test_capacity_tree():
    rng = random.Random(1)
    tree, present = CapacityTree(100), set()
    for _ in range(2000):
        x = rng.randint(0, 100)
        present.symmetric_difference_update({x})
        tree.set(x, x in present)
        need = rng.randint(0, 100)
        assert tree.tightest(need) == min((p for p in present if p >= need), default=None)


def test_awkward_rows(edge_docs, no_docs, tokenizer):
    rows = best_fit_packing(edge_docs, settings.packing_tokenizer()).collect()
    want = _want(tokenizer, [(r.doc_id, r.text) for r in edge_docs.collect()])
    assert {(r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows} == want
    assert len(rows) == len(want) + 1  # one row is repeated
    assert (2, 0, 0, 1, zlib.crc32(b"\0\0\0\0")) in want
    _check_bins(rows)
    assert best_fit_packing(no_docs, settings.packing_tokenizer()).count() == 0
