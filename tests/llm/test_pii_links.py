"""Random personal data: pseudonyms keep the format, lead back with the key, and link equal values."""

import random
from datetime import date, timedelta

import pytest

from driftgate.llm import pii

KEY = b"k"


def new_of(text, back=False):
    out = pii.replaced(text.encode(), KEY, back)[0]
    return text if out is None else out.decode()


def some_day(rng):
    return date(1900, 1, 1) + timedelta(rng.randrange(73_000))


def iban(rng):
    country, body = rng.choice(["DE", "GB", "FR"]), ""
    body = "".join(rng.choice("0123456789") for _ in range(pii.IBAN_LENGTHS[country] - 4))
    return f"{country}{98 - pii._mod97(body + country + '00'):02d}{body}"


def card(rng):
    digits = "".join(rng.choice("0123456789") for _ in range(15))
    return digits + pii.luhn_digit(digits)


VALUES = {
    "iso": lambda r: some_day(r).isoformat(),
    "short": lambda r: "{0.year}-{0.month}-{0.day}".format(some_day(r)),
    "american": lambda r: some_day(r).strftime("%m/%d/%Y"),
    "short american": lambda r: "{0.month}/{0.day}/{0.year}".format(some_day(r)),
    "day first": lambda r: some_day(r).replace(day=r.randint(13, 28)).strftime("%d/%m/%Y"),
    "dotted": lambda r: some_day(r).strftime("%d.%m.%Y"),
    "short dotted": lambda r: "{0.day}.{0.month}.{0.year}".format(some_day(r)),
    "phone": lambda r: f"+{r.choice(['1', '49', '44', '353', '998'])} {r.randint(10, 999)} {r.randint(100, 9999)} {r.randint(100, 9999)}",
    "american phone": lambda r: f"({r.randint(200, 999)}) {r.randint(200, 999)}-{r.randint(1000, 9999)}",
    "ssn": lambda r: f"{r.randint(1, 665):03d}-{r.randint(1, 99):02d}-{r.randint(1, 9999):04d}",
    "ip": lambda r: ".".join(str(r.randint(0, 255)) for _ in range(4)),
    "email": lambda r: f"{r.choice(['ann', 'Bob', 'x1'])}.{r.randint(0, 999)}@mail.example.org",
    "iban": iban,
    "card": card,
}


@pytest.mark.parametrize("kind", VALUES)
def test_format_and_inverse(kind):
    rng = random.Random(kind)
    values = {VALUES[kind](rng) for _ in range(400)}
    found = {v: new_of(v) for v in values}
    assert len(set(found.values())) == len(values)
    for old, new in found.items():
        assert len(new) == len(old) and [c.isdigit() for c in new] == [c.isdigit() for c in old]
        assert new_of(new, back=True) == old
    assert sum(a != b for a, b in found.items()) >= 0.99 * len(values)


def digits(text):
    return "".join(c for c in text if c.isdigit())


@pytest.mark.parametrize("spellings", [
    ("+49 30 1234567", "+49301234567", "+49-30-1234567", "+49 (30) 123 4567"),
    ("+353 86 123 4567", "+353861234567"),
    ("(988) 555-2485", "988-555-2485", "988.555.2485"),
    ("4111 1111 1111 1111", "4111-1111-1111-1111", "4111111111111111"),
])
def test_spellings_link(spellings):
    assert len({digits(new_of(s)) for s in spellings}) == 1
    assert digits(new_of(spellings[0])) != digits(spellings[0])


def test_country_stays_and_joins_the_national_number():
    assert new_of("+49 30 1234567").startswith("+49 ")
    assert digits(new_of("+1 988 555 2485"))[1:] == digits(new_of("988-555-2485"))


def test_notations_link_where_they_can():
    days = [date(2000, 1, 1) + timedelta(i) for i in range(500)]
    for form in ("%d.%m.%Y", "%m/%d/%Y", "%d-%m-%Y", "%Y/%m/%d"):
        for d in days:
            new = date.fromisoformat(new_of(d.isoformat()))
            assert new_of(d.strftime(form)) == new.strftime(form)
    late = [d for d in days if d.day > 12]
    linked = [new_of(d.strftime("%d/%m/%Y")) == date.fromisoformat(new_of(d.isoformat())).strftime("%d/%m/%Y") for d in late]
    assert 0.5 < sum(linked) / len(linked) < 1
