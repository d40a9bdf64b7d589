"""Texts that repeat the start of a pattern very often are read in linear time."""

import time

from hypothesis import given, settings
from hypothesis import strategies as st

from spark_elt.llm import secrets

TOKEN = secrets._MORE[1][1]


@given(st.lists(st.sampled_from(["eyJ", "a", "abcdefgh", ".", "-_1", " ", "xeyJ", "0" * 9, "eyJ12345678.abcdefgh.ijklmnop", "\n"]), max_size=24).map("".join))
@settings(max_examples=600, deadline=None)
def test_signed_tokens_as_by_the_pattern(text):
    assert list(secrets._signed(text)) == [m.span() for m in TOKEN.finditer(text)]


def test_long_run_of_token_starts():
    begin = time.process_time()
    assert secrets.find("eyJ" * 350_000) == []
    assert time.process_time() - begin < 5
