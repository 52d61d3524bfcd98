import zlib

import numpy as np
import pyarrow as pa
import pytest

from lexitrend.llm import op6_packing as packing
from lexitrend.llm import op8_token_file as files
from lexitrend.llm.common import table, work_dir
from lexitrend.llm.tokens import Encoder
from tests.llm import edge

SF = "/root/testdata/sf0.001"
ODD = ["a  b", "  x", "a \n b\n", "it's ~ tilde~x ~", "<|endoftext|> hi", " a  b", "a\tb c\t", "É é ́x", "a ", "", "x\n\n y",
       "한국 어 12 3", "a b c", "ONE!! two*** three$$$ x.y,z don't", "İstanbul ǅ ª º", "~", " ~ ~", "a　 b"]


def direct(kind: str, texts: list) -> list[np.ndarray]:
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(edge.tokenizer(kind))
    t.encode_special_tokens = True
    return [np.array(e.ids, "<u4") for e in t.encode_batch([x or "" for x in texts], add_special_tokens=False)]


@pytest.mark.parametrize("kind", ["byte", "word"])
def test_encoder_gives_the_librarys_ids(spark, kind):
    texts = [r["text"] for r in table(spark, SF, "documents").select("text").collect()] + ODD + [edge.LONG]
    enc = Encoder(edge.tokenizer(kind))
    for part in (texts, texts[::-1]):    # the second time from known pieces
        ids, size = enc.encode(pa.array(part))
        for got, want in zip(np.split(ids, np.cumsum(size)), direct(kind, part), strict=False):
            assert np.array_equal(got, want)
        assert len(size) == len(part) and size.sum() == len(ids)
    assert enc.encode(pa.array([], pa.string()))[0].tolist() == [] and enc.encode(pa.array([None, ""]))[1].tolist() == [0, 0]


def with_end(kind: str, text) -> np.ndarray:
    return np.append(direct(kind, [text])[0], np.uint32(2)).astype("<u4")


def test_code_lengths_and_blocks():
    rng = np.random.default_rng(0)
    counts = (1e6 / np.arange(1, 3001) ** 1.3).astype(np.int64) + 1
    counts[17] = 0
    for limit in (12, 15, 20):
        lengths = files.code_lengths(counts, limit)
        assert lengths.max() <= limit and lengths[17] == 0
        assert sum(2.0 ** -lengths[lengths > 0]) == pytest.approx(1)
    import heapq

    heap = [int(c) for c in counts if c]
    heapq.heapify(heap)
    best = 0
    while len(heap) > 1:
        both = heapq.heappop(heap) + heapq.heappop(heap)
        best += both
        heapq.heappush(heap, both)
    assert (counts * files.code_lengths(counts, 40)).sum() == best      # no limit: Huffman's cost
    lengths = files.code_lengths(counts, 14)
    codes = files.canonical_codes(lengths)
    look, top = files.decode_table(lengths, codes)
    for n in (1, 511, 512, 513, 20_001):
        ids = rng.choice(3000, n, p=counts / counts.sum())
        payload, marks = files.encode_block(ids, lengths, codes)
        assert np.array_equal(files.decode_block(payload, marks, n, look, top), ids)
    assert files.code_lengths(np.array([0, 5])).tolist() == [0, 1]


def test_round_trip(spark):
    path = work_dir(spark) + "/t"
    tokens = files.token_rows(edge.documents(spark), edge.tokenizer("byte"), 2).persist()
    files.write_files(tokens, path)
    got = files.read_files(spark, path, with_ids=True).orderBy("start").collect()
    assert len(got) == len(edge.ROWS)
    assert [r["doc_id"] for r in got] == sorted((i for i, _ in edge.ROWS), key=lambda i: (i is not None, i or 0))
    at, left = 0, {}
    for i, t in edge.ROWS:
        left.setdefault(i, []).append(with_end("byte", t).tolist())
    for r in got:
        assert r["start"] == at and r["ids"] in left[r["doc_id"]]
        left[r["doc_id"]].remove(r["ids"])
        ids = np.array(r["ids"], "<u4")
        assert (r["n_tokens"], r["ids_crc32"]) == (len(ids), zlib.crc32(ids.tobytes()))
        at += len(ids)
    tokens.unpersist()
    assert files.round_trip(edge.empty(spark), edge.tokenizer("byte")).collect() == []


def test_packing(spark):
    got = packing.pack(edge.documents(spark), edge.tokenizer("word")).toPandas()
    want = []
    for i, t in edge.ROWS:
        ids = with_end("word", t)
        want += [(i, a, len(p), zlib.crc32(p.tobytes()), len(ids)) for a in range(0, len(ids), 4096)
                 for p in (ids[a:a + 4096],)]
    columns = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
    assert sorted(map(str, want)) == sorted(str((None if i != i else int(i), *map(int, r))) for i, *r in got[columns].to_numpy())
    for _, s in got.sort_values("offset").groupby("sequence_id"):
        assert s["length"].sum() <= 4096
        assert s["offset"].tolist() == (s["length"].cumsum() - s["length"]).tolist()
    assert packing.pack(edge.empty(spark), edge.tokenizer("word")).collect() == []


def test_packing_wastes_little(spark):
    got = packing.pack(table(spark, "/root/testdata/sf0.01", "documents"), edge.tokenizer("word")).toPandas()
    used = got.groupby("sequence_id")["length"].sum()
    assert used.max() <= 4096 and (4096 * len(used) - used.sum()) / used.sum() < 0.02


def test_cutting_plan_covers_exactly():
    rng = np.random.default_rng(3)
    sizes = np.arange(1, 65)
    for high in (1, 2, 30, 5000):
        demand = rng.integers(0, high + 1, 64) * (sizes < 33)     # for these, full sequences exist
        plan = packing.cutting_plan(demand)
        assert (sum((p * n for p, n in plan), np.zeros(64, np.int64)) == demand).all()
        assert all((p * sizes).sum() <= 64 for p, _ in plan)
        if high == 5000:
            assert sum(n for _, n in plan) <= 1.03 * (demand * sizes).sum() / 64 + 2
    duals = rng.random(20)
    best = max((duals * p).sum() for p in _patterns(20))
    assert (packing.price(duals, 20) * duals).sum() == pytest.approx(best)
    assert packing.cutting_plan(np.zeros(64, np.int64)) == []


def _patterns(capacity: int, largest: int | None = None):
    """All patterns that fill at most ``capacity`` (partitions of each smaller sum)."""
    def fill(room, size):
        if size == 0:
            yield []
            return
        for n in range(room // size + 1):
            for rest in fill(room - n * size, size - 1):
                yield rest + [n]
    for p in fill(capacity, min(capacity, largest or 8)):
        yield np.array(p + [0] * (capacity - len(p)))
    for s in range(9, capacity + 1):
        for p in fill(capacity - s, min(capacity - s, 8)):
            q = np.array(p + [0] * (capacity - len(p)))
            q[s - 1] += 1
            yield q
            if 2 * s <= capacity:
                r = np.zeros(capacity, int)
                r[s - 1] = 2
                yield r


def test_encoder_keeps_words_from_slice_to_slice(monkeypatch):
    """Words met in one slice are not encoded again in the next (they were before), and ids are the
    library's with room for all words, for one and for none."""
    import pyarrow as pa
    import public_tokenizers

    from lexitrend.llm import tokens as T

    slices = [["der Hund und die Katze\nunten", None, "  doppelt"], ["die Katze und der Vogel, unten\nunten", ""], ["Vogel Hund"]]
    for name in ("byte_bpe_50k.json", "word_bpe_49k.json"):
        for room in (T.MAX_WORDS, 1, 0):
            monkeypatch.setattr(T, "MAX_WORDS", room)
            e, asked = T.Encoder(public_tokenizers.path(name), split_added=False), []
            real = e._some_words
            monkeypatch.setattr(e, "_some_words", lambda gap, words: asked.append((gap, words)) or real(gap, words))
            for texts in slices:
                ids, size = e.encode(pa.array(texts, pa.string()))
                want = [x.ids for x in e.tok.encode_batch_fast([t or "" for t in texts], add_special_tokens=False)]
                assert ids.tolist() == [i for w in want for i in w] and size.tolist() == list(map(len, want))
            words = [w for gap, ws in asked for w in ws if gap == " "]
            assert len(words) == len(set(words)) or room < 2
            monkeypatch.undo()
