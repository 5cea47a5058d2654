"""Column expressions over names, labels and error texts."""

from __future__ import annotations

import re

from pyspark.sql import Column, functions as F

from girolens import model

_BLANKS = " \t\r\n"


def _tight(col: Column) -> Column:
    """Whether text begins and ends with something above the blanks, so that it need not be taken apart to be trimmed."""
    return (F.ascii(col) > ord(" ")) & (F.ascii(F.substring(col, -1, 1)) > ord(" "))


def text(col: Column) -> Column:
    """Element text without surrounding white space; empty becomes NULL."""
    return F.when(_tight(col), col).otherwise(F.nullif(F.btrim(col, F.lit(_BLANKS)), F.lit("")))


def stripped(col: Column) -> Column:
    """Element text without surrounding white space; empty stays ''."""
    return F.btrim(col, F.lit(_BLANKS))


def file_category(name: Column, strict: bool = False) -> Column:
    """Expected outcome stated by a file name.

    ``strict`` asks for the dash after the prefix (``gen-pass-…``).
    """
    tail = "-" if strict else ""
    known = model.CATEGORIES[:-1]
    chain = F.when(name.startswith(known[0] + tail), known[0])
    for prefix in known[1:]:
        chain = chain.when(name.startswith(prefix + tail), prefix)
    return chain.otherwise(model.CATEGORIES[-1])


def strip_namespaces(message: Column) -> Column:
    return F.regexp_replace(message, r"\{[^}]+\}", "")


def failing_element(detail: Column, closed: bool = True) -> Column:
    """Local name after a ``{namespace}``; '' when there is none.

    ``closed`` wants the name to be followed by a quote or a colon.
    """
    pattern = "[}]([A-Za-z]+)[':]" if closed else "[}]([A-Za-z]+)"
    return F.regexp_extract(detail, pattern, 1)


def _first_match(detail: Column, rules: list[tuple[list[str], str]], fallback: str) -> Column:
    chain = None
    for markers, label in rules:
        hit = detail.contains(markers[0])
        for marker in markers[1:]:
            hit = hit | detail.contains(marker)
        chain = F.when(hit, label) if chain is None else chain.when(hit, label)
    return chain.otherwise(fallback)


# Markers in the order in which they are tried, with both wordings.
ERROR_TYPES: list[tuple[list[str], str, str]] = [
    (["is not expected"], "Wrong element order / unexpected element", "Element order"),
    (["Missing child element"], "Missing required element", "Missing required"),
    (["not a valid value"], "Invalid field value", "Invalid value"),
    (["minLength", "maxLength"], "String length constraint", "Length constraint"),
    (["pattern"], "Pattern / regex mismatch", "Pattern mismatch"),
    (["facet"], "Facet constraint violation", "Facet violation"),
]

ERROR_CATEGORIES: list[tuple[list[str], str]] = [
    (["facet 'enumeration'"], "Invalid enumeration value"),
    (["facet 'pattern'"], "Pattern / format violation"),
    (["facet 'maxLength'"], "String exceeds max length"),
    (["facet 'minLength'"], "Empty required field"),
    (["facet 'minInclusive'"], "Value below minimum"),
    (["facet 'totalDigits'"], "Too many digits"),
    (["facet 'fractionDigits'"], "Too many decimal places"),
    (["Missing child element"], "Missing required element"),
    (["not expected"], "Wrong element order"),
    (["XML syntax error"], "XML syntax error"),
    (["attribute 'Ccy'"], "Missing currency (Ccy) attribute"),
]

# Advice per kind of schema error; {0}, {1} are capture groups.
ADVICE: list[tuple[str, str]] = [
    (r"(?s)not expected.*Expected is[^{]*\{[^}]+\}(\w+)",
     "Element is in the wrong position or misspelled. "
     "The schema expects '{0}' at this point — verify the element sequence in the XSD."),
    (r"\[facet 'enumeration'\].*value '([^']+)' is not an element of the set",
     "'{0}' is not an allowed code for this field. Consult the schema enumeration. "
     "Common sets — ChargeBearerType: DEBT, CRED, SHAR, SLEV; "
     "PaymentMethod: TRF, CHK, TRA; "
     "ChequeType: CCHQ, CCCH, BCHQ, DRFT, ELDR; "
     "ExchangeRateType: SPOT, SALE, AGRD; "
     "Priority: NORM, HIGH."),
    (r"attribute 'Ccy'",
     "The 'Ccy' attribute is missing or invalid. "
     "Currency codes must be exactly 3 uppercase letters (e.g. EUR, USD, GBP)."),
    (r"\[facet 'pattern'\].*not accepted by the pattern '([^']+)'",
     "Value does not match the required format pattern. "
     "Common issues — IBAN: 2 uppercase letters + 2 digits + 1-30 alphanumeric; "
     "BIC: 8 or 11 uppercase alphanumeric characters; "
     "UETR (UUID v4): third group must start with '4', fourth with '8', '9', 'a', or 'b'. "
     "Schema pattern: {0}"),
    (r"Missing child element.*Expected is[^{]*\{[^}]+\}(\w+)",
     "Required child element '{0}' is absent. "
     "Insert it in the correct sequence position within the parent element."),
    (r"\[facet 'minLength'\].*length of 0",
     "Field is empty but requires at least one character. Provide a non-empty value."),
    (r"\[facet 'maxLength'\].*length of (\d+).*maximum.*?(\d+)",
     "Value is {0} characters — maximum allowed is {1}. Shorten the value."),
    (r"\[facet 'minInclusive'\].*value '([^']+)'.*minimum value.*'([^']+)'",
     "'{0}' is below the minimum allowed ({1}). Amounts and rates must be zero or positive."),
    (r"\[facet 'totalDigits'\]",
     "Too many digits in total. ISO 20022 amounts allow at most 18 digits in total."),
    (r"\[facet 'fractionDigits'\]",
     "Too many decimal places. "
     "Amounts allow up to 5 decimal places; exchange rates allow up to 10."),
]
ADVICE_FALLBACK = (
    "Review this element against the XSD definition. "
    "Check value format, length constraints, allowed codes, and element ordering."
)


def error_type(detail: Column, short: bool = False) -> Column:
    """Seven-way class of a validation error; NULL falls in ``Other``."""
    rules = [(markers, brief if short else full) for markers, full, brief in ERROR_TYPES]
    return _first_match(detail, rules, "Other")


def error_category(detail: Column) -> Column:
    """Twelve-way class of a validation error."""
    return _first_match(detail, ERROR_CATEGORIES, "Other validation error")


def suggest_fix(message: Column) -> Column:
    """Advice for a schema error: the first matching kind, filled with its captures."""
    chain = None
    for pattern, template in ADVICE:
        pieces = []
        for part in re.split(r"(\{\d\})", template):
            slot = re.fullmatch(r"\{(\d)\}", part)
            if slot:
                pieces.append(F.regexp_extract(message, pattern, int(slot.group(1)) + 1))
            elif part:
                pieces.append(F.lit(part))
        hit, advice = message.rlike(pattern), F.concat(*pieces)
        chain = F.when(hit, advice) if chain is None else chain.when(hit, advice)
    return chain.otherwise(ADVICE_FALLBACK)


def error_summary(messages: Column, first: int | None = None) -> Column:
    """Error texts joined with '; ' and cut to the length of the state column."""
    kept = messages if first is None else F.slice(messages, 1, first)
    return F.substring(F.array_join(kept, "; "), 1, model.ERROR_DETAIL_LENGTH)


def label(code: Column, labels: dict[str, str], fallback: str | None = None) -> Column:
    """Small fixed lookup (at most a few dozen entries) as a map literal."""
    pairs = [F.lit(item) for pair in labels.items() for item in pair]
    found = F.element_at(F.create_map(*pairs), code)
    return found if fallback is None else F.coalesce(found, F.lit(fallback))


def set_label(message_set: Column) -> Column:
    return label(message_set, model.SET_LABELS)


def domain_label(domain: Column) -> Column:
    return label(F.split_part(domain, F.lit("."), F.lit(1)), model.DOMAIN_LABELS,
                 model.DOMAIN_FALLBACK)


def is_domain_name(domain: Column) -> Column:
    return domain.rlike(model.DOMAIN_PATTERN)


def pass_band(rate: Column) -> Column:
    """Traffic light of a pass rate in percent."""
    return F.when(rate >= 80, "good").when(rate >= 50, "fair").otherwise("poor")


def validation_badge(passed: Column, warnings: Column) -> Column:
    return F.when(passed & (warnings > 0), "WARN").when(passed, "PASS").otherwise("FAIL")


def xml_escape(col: Column) -> Column:
    """Character data that is safe inside an element or an attribute."""
    out = F.replace(col, F.lit("&"), F.lit("&amp;"))
    for raw, entity in (("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        out = F.replace(out, F.lit(raw), F.lit(entity))
    return out
