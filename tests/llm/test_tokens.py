"""Token counts, shards and packing against whole-text encoding."""

from __future__ import annotations

import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from riskloom.llm.packing import Plan, fill, pack
from riskloom.llm.token_count import Counter, count_tokens
from riskloom.llm.vocabulary import Encoder, Kept, definition
from riskloom.llm.wavelet import WaveletMatrix, documents_of, read_shards, write_shards

PIECE, WORD = public_tokenizers.path("piece_bpe_32k.model"), public_tokenizers.path("word_bpe_49k.json")
TEXTS = [
    None, "", " ", "a", "  two  spaces ", "▁bar a▁ b ▁", "line\nline\n\n end\n", "don't I'll it's 'S ''s", "<|endoftext|> x<|startoftext|>",
    "<s> </s> <unk>", "Ünïcode İstanbul ΣΑΣ ﬁ é ñ", "日本語 テキスト🎉", "x" * 5000, "word " * 3000, "12 345 ½ a1b2", "tab\tsep\x1c\x85\xa0", "the same", "the same",
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i if i != 4 else None, t, "x", 1, 2) for i, t in enumerate(TEXTS)] + [(16, "the same", "y", 1, 2)]
    return spark.createDataFrame(rows, "doc_id long, text string, n_tokens string, k int, part int").repartition(3)


ENCODER = Encoder(definition(WORD))
with open(PIECE, "rb") as f:
    COUNTER = Counter(f.read(), 1 << 20)


def ids_of(text):
    return [*ENCODER.tokenizer.encode(text or "", add_special_tokens=False).ids, 2]


def checksum(ids):
    return zlib.crc32(np.array(ids, dtype="<u4").tobytes())


def test_token_counts_equal_whole_text_encoding(spark, docs):
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=PIECE)
    got = sorted((r.doc_id is None, r.doc_id or 0, r.n_bytes, r.n_tokens, r.over_limit) for r in count_tokens(docs, PIECE, 100).collect())
    want = []
    for r in docs.collect():
        n = len(sp.encode(r.text or ""))
        want.append((r.doc_id is None, r.doc_id or 0, len((r.text or "").encode()), n, n > 100))
    assert got == sorted(want)
    assert count_tokens(docs.limit(0), PIECE).count() == 0


@settings(max_examples=300, deadline=None)
@given(st.text(st.sampled_from("aB .,'s1½ \n\t▁é<|>İßΣ́"), max_size=30))
def test_pieces_equal_whole_text_encoding(text):
    assert ENCODER.ids(text).tolist() == ids_of(text)[:-1]
    assert COUNTER.count([text]) == [len(COUNTER.model.encode(text))]


def test_words_and_pieces_are_kept_once(monkeypatch):
    """A worker keeps a bounded number of strings in all, and ids stay those of whole texts."""
    monkeypatch.setattr("riskloom.llm.vocabulary.KEPT", 300)
    monkeypatch.setattr("riskloom.llm.vocabulary.TOGETHER", 400)
    encoder = Encoder(definition(WORD))
    texts = [" ".join(f"w{'abcdefgh'[i % 8]}{chr(97 + j % 26)}x{'.,é'[j % 3]}q{chr(97 + i % 26)}" for j in range(20)) for i in range(60)] + ["don't I'll 'S ''s a1b2"]
    kept = [x for x in vars(encoder).values() if hasattr(x, "learn")]
    for t, ids in zip(texts * 2, encoder.many(texts * 2), strict=True):
        assert ids.tolist() == ids_of(t)[:-1]
        assert 0 < sum(len(k.new) + len(k.old) for k in kept) <= 2 * 300 + 100


def test_words_that_fit_are_made_once(monkeypatch):
    monkeypatch.setattr("riskloom.llm.vocabulary.KEPT", 300)
    made = []
    kept = Kept(lambda words, known: made.extend(words) or {w: w.encode() for w in words})
    groups = [{f"w{i}" for i in range(lo, lo + 50)} for lo in range(0, 550, 50)]
    for g in groups * 3:
        found = kept.learn(g)
        assert all(found[w] == w.encode() for w in g)
    assert sorted(made) == sorted(set().union(*groups))
    for lo in range(1000, 9000, 50):
        # one that is met all the time is made again at most once
        kept.learn({f"w{i}" for i in range(lo, lo + 50)} | {"w549"})
        assert len(kept.new) + len(kept.old) <= 600
    assert made.count("w549") <= 2


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 40), max_size=1500))
def test_wavelet_matrix(ids):
    m = WaveletMatrix.from_bytes(WaveletMatrix.build(np.array(ids, dtype=np.uint32), 6).to_bytes())
    assert m.decode().tolist() == ids
    for i in range(0, len(ids), 97):
        assert m.access(i) == ids[i] and m.rank(ids[i], i) == ids[:i].count(ids[i])
        k = ids[:i].count(ids[i])
        assert m.select(ids[i], k) == i and m.count(ids[i]) == ids.count(ids[i])
    assert m.count(63) == 0 and m.count(1000) == 0


def test_shards_round_trip(spark, docs, tmp_path):
    write_shards(docs, str(tmp_path / "s"), WORD, shard_tokens=50)
    shards = read_shards(spark, str(tmp_path / "s"))
    assert shards.count() > 4
    got = sorted(((r.doc_id is not None, r.doc_id or 0, r.start, r.n_tokens, r.ids_crc32) for r in documents_of(shards).collect()), key=lambda r: r[2])
    assert [g[:2] for g in got] == sorted(g[:2] for g in got)
    at = 0
    for g in got:
        assert g[2] == at
        at += g[3]
    want = sorted((r.doc_id is not None, r.doc_id or 0, len(ids_of(r.text)), checksum(ids_of(r.text))) for r in docs.collect())
    assert sorted((a, b, d, e) for a, b, _, d, e in got) == want
    write_shards(docs.limit(0), str(tmp_path / "e"), WORD)
    assert documents_of(read_shards(spark, str(tmp_path / "e"))).count() == 0


@settings(max_examples=100, deadline=None)
@given(st.dictionaries(st.integers(1, 12), st.integers(1, 4), max_size=5), st.integers(0, 30))
def test_fill_is_the_best_sum(counts, capacity):
    got = fill(counts, capacity)
    sums = {0}
    for length, c in counts.items():
        sums = {s + length * k for s in sums for k in range(c + 1)}
    assert all(v <= counts[k] for k, v in got.items())
    assert sum(k * v for k, v in got.items()) == max(s for s in sums if s <= capacity)


@settings(max_examples=100, deadline=None)
@given(st.dictionaries(st.integers(1, 31), st.integers(1, 50), max_size=12))
def test_plan_covers_all_and_only_the_last_window_is_short(histogram):
    plan = Plan(histogram, 32)
    windows: dict[int, list] = {}
    pieces: dict[tuple, list] = {}
    for whole, lo, hi, cut, n, first, each, index, offset in plan.rows:
        for r in range(lo, hi):
            i = index + r - lo
            windows.setdefault(first + i // each, []).append((offset + i % each * n, n))
            pieces.setdefault((whole, r), []).append((cut, n))
    assert sorted(windows) == list(range(plan.windows))
    short = 0
    for found in windows.values():
        at = 0
        for offset, n in sorted(found):
            assert offset == at
            at += n
        assert at <= 32
        short += at < 32
    assert short <= 1
    assert len(pieces) == sum(histogram.values())
    for (whole, _), found in pieces.items():
        at = 0
        for cut, n in sorted(found):
            assert cut == at
            at += n
        assert at == whole


@pytest.mark.parametrize("copies", [1, 40])
def test_packing_keeps_every_id_once(spark, docs, copies):
    rows = docs
    if copies > 1:  # one length owns most rows: windows can only be filled by cutting
        rows = spark.createDataFrame([(i, "a b c d e f g h i j") for i in range(copies)], "doc_id long, text string").repartition(3)
    out = pack(rows, WORD, 16, with_ids=True).collect()
    plain = pack(rows, WORD, 16).collect()
    cols = ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")
    assert sorted(str([r[c] for c in cols[1:5]]) for r in out) == sorted(str([r[c] for c in cols[1:5]]) for r in plain)
    windows: dict[int, list] = {}
    for r in out:
        ids = np.frombuffer(r.ids, "<u4")
        assert len(ids) == r.length and checksum(ids) == r.ids_crc32
        windows.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert sorted(windows) == list(range(len(windows)))
    for found in windows.values():
        ends = [0, *np.cumsum([n for _, n in sorted(found)]).tolist()]
        assert [o for o, _ in sorted(found)] == ends[:-1] and ends[-1] <= 16
    assert sum(sum(n for _, n in f) < 16 for f in windows.values()) <= 1
    whole = sorted((r.doc_id is None, r.doc_id or 0, len(ids_of(r.text))) for r in rows.collect())
    by_doc: dict = {}
    for r in plain:
        by_doc.setdefault((r.doc_id is None, r.doc_id or 0, r.doc_tokens), []).append((r.start, r.length))
    assert sum(n for f in by_doc.values() for _, n in f) == sum(n for *_, n in whole)
    assert sorted(set(by_doc)) == sorted(set(whole))
    assert pack(rows.limit(0), WORD, 16).count() == 0
