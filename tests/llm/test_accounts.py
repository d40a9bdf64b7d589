"""Account numbers with words around them."""

import pytest

from spark_elt.llm import personal

DE, NO, GB = "DE89 3704 0044 0532 0130 00", "NO93 8601 1117 947", "GB29NWBK60161331926819"


@pytest.mark.parametrize("account", [DE, DE.replace(" ", ""), NO, GB, "MT84 MALT 0110 0001 2345 MTLC AST0 01S"])
@pytest.mark.parametrize("before", ["", "IBAN ", "AB12 ", "KONTO NR12 "])
@pytest.mark.parametrize("after", ["", " BIC COBADEFFXXX", " BIC COBA", " 12", ".", " USD 1000 AND MORE WORDS"])
def test_words_around_accounts(account, before, after):
    assert [h for h in personal.find(before + account + after) if h[0] == 4] == [(4, len(before), len(before + account))]


def test_accounts_in_a_row():
    assert [h[1:] for h in personal.find(f"{DE} {NO} {GB}") if h[0] == 4] == [(0, 27), (28, 46), (47, 69)]
    assert [h for h in personal.find("DE88 3704 0044 0532 0130 00 BIC") if h[0] == 4] == []


def test_unknown_country_at_any_end():
    number = next(f"QQ{k:02d}ABCDEFGHIJKLMN12" for k in range(100) if personal.mod97(f"QQ{k:02d}ABCDEFGHIJKLMN12"))
    assert (4, 0, 20) in personal.find(number) and (4, 0, 20) in personal.find(f"{number} X")


def test_many_candidates_take_linear_time():
    assert [h for h in personal.find("AA11 " * 50_000) if h[0] == 4] == []
