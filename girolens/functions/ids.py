"""Column expressions over identifiers: accounts, banks, references, topics."""

from __future__ import annotations

import string
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, functions as F

from girolens import model

_PART, _PARTS = 18, 4  # four parts of 18 digits hold the longest account number (34 characters), and a part fits a bigint
_SHIFT = pow(10, _PART, 97)


def iban_country(iban: Column) -> Column:
    return F.when(F.length(iban) >= 2, F.upper(F.substring(iban, 1, 2)))


def bic_country(bic: Column) -> Column:
    return F.when(F.length(bic) >= 6, F.upper(F.substring(bic, 5, 2)))


Bind = Callable[[Column, Callable[[Column], Column]], Column]


def _inline(value: Column, build: Callable[[Column], Column]) -> Column:
    return build(value)


def iban_remainder(iban: Column, bind: Bind = _inline) -> Column:
    """ISO 7064 MOD 97-10 remainder of a compact upper-case account number.

    The number has up to 68 digits once letters are expanded, so it is cut into
    four integers that are reduced one after the other modulo 97.
    """
    rest_of = F.substring(iban, 5, 34)
    letters = reduce(
        lambda text, letter: F.replace(text, F.lit(letter), F.lit(str(ord(letter) - 55))),
        string.ascii_uppercase,
        rest_of,
    )

    def value(position: int) -> Column:
        return (F.ascii(F.substring(iban, position, 1)) - 55).cast("string")

    # most numbers have letters in the country only
    digits = F.concat(
        F.when(rest_of.rlike("[A-Z]"), letters).otherwise(rest_of), value(1), value(2), F.substring(iban, 3, 2)
    )

    def whole(padded: Column) -> Column:
        parts = [F.substring(padded, 1 + n * _PART, _PART).try_cast("bigint") for n in range(_PARTS)]
        return reduce(lambda rest, part: F.pmod(rest * _SHIFT + F.pmod(part, F.lit(97)), F.lit(97)), parts[1:], F.pmod(parts[0], F.lit(97)))

    return bind(F.lpad(digits, _PARTS * _PART, "0"), whole)


def iban_is_valid(iban: Column, bind: Bind = _inline) -> Column:
    """``bind`` keeps parts from being evaluated anew where no generated code shares them (``once.bound`` in lambdas)."""
    def sound(compact: Column) -> Column:
        shaped = compact.rlike("^[A-Z]{2}[0-9]{2}[A-Z0-9]{1,30}$")
        return F.coalesce(F.when(shaped, iban_remainder(compact, bind) == 1), F.lit(False))

    return bind(F.upper(F.replace(iban, F.lit(" "), F.lit(""))), sound)


def bic_is_valid(bic: Column) -> Column:
    return F.upper(bic).rlike(model.BIC_PATTERN)


def uetr_is_valid(uetr: Column) -> Column:
    return uetr.rlike(model.UUID4_PATTERN)


def currency_is_active(code: Column) -> Column:
    return F.upper(code).isin(model.CURRENCIES)


def content_id(domain: Column, message_set: Column, content: Column) -> Column:
    """Message identity: digest of the addressed raw bytes."""
    address = F.encode(F.concat(domain, F.lit("."), message_set, F.lit(":")), "UTF-8")
    return F.sha2(F.concat(address, content), 256)


def content_digest(content: Column) -> Column:
    """Digest carried with a payload; taken over bytes, never over decoded text."""
    return F.base64(F.unhex(F.sha2(content, 256)))


def topic_name(domain: Column, message_set: Column) -> Column:
    return F.concat_ws(".", F.lit(model.TOPIC_PREFIX), domain, message_set)


def schema_label(domain: Column, message_set: Column) -> Column:
    return F.concat(domain, F.lit("."), message_set)
