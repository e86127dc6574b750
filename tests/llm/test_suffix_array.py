import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from bazaarlake.llm.suffix_array import suffix_orders


def check(texts):
    arrays = [np.r_[np.array(list(t), np.int64) + 1, 0] for t in texts]
    starts = np.cumsum([0, *(len(a) for a in arrays)])[:-1]
    got = suffix_orders(np.concatenate(arrays) if arrays else np.zeros(0, np.int64), starts)
    at = 0
    for a, s in zip(arrays, starts):
        want = sorted(range(len(a)), key=lambda i: a[i:].tolist())
        assert (got[at : at + len(a)] - s).tolist() == want
        at += len(a)


@settings(deadline=None, max_examples=300)
@given(st.lists(st.lists(st.integers(0, 3), max_size=40), max_size=6))
def test_orders_equal_sorted_suffixes(texts):
    check(texts)


def test_runs_words_and_single_letters():
    check([b"", b"a", b"aaaaaaaa", b"abababab", b"banana", b"mississippi", b"gccttaacattattacgccta", b"zyx", b"abcabcabd" * 9])
