"""Coding of one block of token ids."""

import tracemalloc

import numpy as np

from lexitrend.llm import op8_token_file as TF


def test_blocks_of_any_length_are_the_plain_bit_string():
    rng = np.random.default_rng(5)
    counts = np.r_[2 ** np.arange(24), np.ones(40, int)]
    lengths = TF.code_lengths(counts)
    codes = TF.canonical_codes(lengths)
    table, top = TF.decode_table(lengths, codes)
    for n in (1, 2, 3, 511, 512, 513, 1023, TF.RUN - 1, TF.RUN, TF.RUN + 1, 2 * TF.RUN + 513):
        ids = rng.integers(0, len(counts), n)
        text = "".join(format(int(codes[i]), f"0{lengths[i]}b") for i in ids)
        payload, marks = TF.encode_block(ids, lengths, codes)
        assert payload == int(text.ljust(-(-len(text) // 8) * 8, "0"), 2).to_bytes(-(-len(text) // 8), "big")
        ends = np.concatenate(([0], np.cumsum(lengths[ids])))
        assert marks.tolist() == ends[:-1][::TF.CHECKPOINT].tolist()
        assert TF.decode_block(payload, marks, n, table, top).tolist() == ids.tolist()


def test_block_coding_takes_little_beside_the_ids():
    """A byte an id for its length, not four; the rest is the payload and one run's arrays."""
    ids = np.random.default_rng(7).integers(0, 256, 1 << 20).astype("<u2")
    lengths = TF.code_lengths(np.ones(256, int))
    codes = TF.canonical_codes(lengths)
    tracemalloc.start()
    TF.encode_block(ids, lengths, codes)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 10 * len(ids)     # 12.4 before
