import numpy as np
import pyarrow as pa
import pytest

from lexitrend.llm import op6_packing as packing
from lexitrend.llm import op8_token_file as files
from lexitrend.llm.tokens import encoder_of
from tests.llm import edge
from tests.llm.test_tokens import ODD

LITERALS = ["one <|endoftext|> two", "<|endoftext|>", "a<|endoftext|>b", "x.<|endoftext|> y\nz", "<|startoftext|> hi <|endoftext|>",
            "<|ENDOFTEXT|> a", "<|endoftext |>"]


@pytest.mark.parametrize("kind", ["byte", "word"])
def test_ids_are_those_of_the_plain_library(spark, kind):
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(edge.tokenizer(kind))
    texts = ODD + LITERALS
    want = [plain.encode(t, add_special_tokens=False).ids for t in texts]
    for part in (slice(None), slice(None, None, -1)):
        ids, size = encoder_of(edge.tokenizer(kind)).encode(pa.array(texts[part]))
        assert [x.tolist() for x in np.split(ids, np.cumsum(size))[:-1]] == want[part]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r["n_tokens"] for r in files.round_trip(docs, edge.tokenizer(kind)).collect()}
    end = min(got[i] - len(w) for i, w in enumerate(want))
    assert end in (0, 1) and all(got[i] == len(w) + end for i, w in enumerate(want))
    packed = {r["doc_id"]: r["doc_tokens"] for r in packing.pack(docs, edge.tokenizer(kind)).collect()}
    assert all(packed[i] == len(w) + 1 for i, w in enumerate(want))
