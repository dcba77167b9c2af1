import random

import numpy as np
import pyarrow as pa
import pytest

from dialtrail.llm.packing import ChunkedTokenizer, tokenizer_path
from dialtrail.llm.texts import slices
from tests.llm.test_packing import expected_ids

PARTS = [" ", "  ", "\n", "\n\n", "\t", "a", "B", "ab", "é", "×", "ÿ", "'s", "'", ".", ",", "...",
         "7", "42", "<|endoftext|>", "日", " x", " ", " ", "ñ", "-", "|", "\x1c", "\x85"]


@pytest.mark.parametrize("seed", range(6))
def test_ids_of_random_texts(seed):
    rng = random.Random(seed)
    texts = ["".join(rng.choices(PARTS, k=rng.randint(0, 30))) for _ in range(800)]
    tokenizer, found = ChunkedTokenizer(tokenizer_path()), []
    for part in slices(pa.array(texts), 2000):
        ids, counts = tokenizer.encode(part)
        found += [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])]
    assert found == [ids[:-1] for ids in expected_ids(texts)]
