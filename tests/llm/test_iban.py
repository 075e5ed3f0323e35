"""IBANs in front of what could be more of them."""

import pytest

from tamarack.llm import pii


@pytest.mark.parametrize("iban", ["DE89370400440532013000", "DE89 3704 0044 0532 0130 00", "GB29 NWBK 6016 1331 9268 19", "NO93 8601 1117 947", "MT84MALT011000012345MTLCAST001S"])
@pytest.mark.parametrize("behind", ["", ".", " ok", " Please pay", " BIC COBADEFF", " 2024", " I will", " DE89370400440532013000", " AB12 Z"])
def test_iban_before_capitals_and_digits(iban, behind):
    text = f"account {iban}{behind}"
    assert [text[s:e] for kind, s, e, _ in pii.find(text) if kind == "iban"] == [iban] + ["DE89370400440532013000"] * behind.startswith(" DE")


def test_iban_of_other_lengths_and_lookalikes():
    plain = "ZZ00" + "1234567890ABCDE"
    check = 98 - int("".join(str(int(c, 36)) for c in plain[4:] + plain[:4])) % 97
    told = f"ZZ{check:02}1234567890ABCDE"  # a country without a fixed length
    ibans = lambda t: [t[s:e] for kind, s, e, _ in pii.find(t) if kind == "iban"]
    assert ibans(f"bank {told} Please") == [told]
    assert ibans("AB12 CDEF DE89370400440532013000 Next") == ["DE89370400440532013000"]
    assert ibans("account DE88370400440532013000 Please pay") == [] and ibans("account DE89370400440532013000x") == []
    for s in ("DE89" * 80_000, "AA11 " * 60_000, "DE89 3704 0044 " * 20_000):
        pii.find(s)
