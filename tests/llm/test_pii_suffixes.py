"""Personal data with more letters or digits behind or before it."""

import pytest

from driftgate.llm import pii


@pytest.mark.parametrize("before, value, after", [
    ("", "DE89370400440532013000", " USD 500"),
    ("", "DE89 3704 0044 0532 0130 00", " BIC COBADEFF"),
    ("IBAN ", "GB82 WEST 1234 5698 7654 32", " EUR 10"),
    ("AB12 ", "DE89 3704 0044 0532 0130 00", ""),
    ("card ", "4111 1111 1111 1111", " 12/27"),
    ("", "4111-1111-1111-1111", " 123"),
    ("12 ", "4111 1111 1111 1111", ""),
    ("", "2024-01-05", "T10:00:00Z"),
    ("", "2024-01-05", "Z"),
    ("99-99-", "2021-02-03", ""),
])
def test_values_beside_more(before, value, after):
    alone = pii.replaced(value.encode(), b"k")[0].decode()
    new, counts = pii.replaced(f"{before}{value}{after}".encode(), b"k")
    assert new.decode() == f"{before}{alone}{after}" and sum(counts.values()) == 1


def test_clean_texts_stay():
    for text in ("DE89370400440532013001 USD 500", "card 4111 1111 1111 1112 1x", "2024-01-05Tx", "2024-13-05T10:00"):
        assert pii.replaced(text.encode(), b"k")[0] is None
