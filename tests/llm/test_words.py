import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from tastegrid.llm.words import distinct_per_text, groups, shingle_hashes, texts_of, word_hashes

texts = st.lists(st.one_of(st.none(), st.text(alphabet="aAbB é\t\n\x0b\x0c\r\x1c\x85日", max_size=30)), max_size=12)


@settings(max_examples=200, deadline=None)
@given(texts, st.integers(1, 40), st.integers(1, 6))
def test_words_and_shingles(rows, limit, width):
    raw, bounds = texts_of(pa.array(rows, pa.string()))
    fold = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    known: dict = {}
    at = 0
    for i, j in groups(bounds, limit):
        assert i == at
        at = j
        hashes, before, _ = word_hashes(raw, bounds[i : j + 1], True)
        shingles, after = shingle_hashes(hashes, before, width)
        different, after_different = distinct_per_text(shingles, after)
        for k in range(j - i):
            words = re.findall(r"[^\x20\x09-\x0D]+", (rows[i + k] or "").translate(fold))
            assert before[k + 1] - before[k] == len(words)
            for word, h in zip(words, hashes[before[k] : before[k + 1]].tolist()):
                assert known.setdefault(word, h) == h
            want = [tuple(words)] if 0 < len(words) < width else [tuple(words[m : m + width]) for m in range(len(words) - width + 1)]
            got = shingles[after[k] : after[k + 1]].tolist()
            assert len(got) == len(want)
            for s, h in zip(want, got):
                assert known.setdefault((s,), h) == h
            assert different[after_different[k] : after_different[k + 1]].tolist() == sorted(set(got))
    assert at == len(rows)
    assert len(set(known.values())) == len(known)


def test_slices_of_a_column():
    column = pa.array(["one two", None, "three", ""], pa.string())
    raw, bounds = texts_of(column.slice(1, 3))
    hashes, before, _ = word_hashes(raw, bounds, True)
    assert before.tolist() == [0, 0, 1, 1] and np.array_equal(hashes, word_hashes(*texts_of(pa.array(["three"])), True)[0])
