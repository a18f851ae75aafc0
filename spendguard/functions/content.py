"""Sensitive-content scan and classification as columns over text.

Expressions are kept small by passing all patterns through one shared body, and values that are
used more than once are bound to a variable so that they are computed once.
"""

from pyspark.sql import Column, functions as F

from . import patterns as P
from .spans import Detector, bind, luhn_valid, redact_spans, remove_overlaps, spans_by_detector

CATEGORIES = ("pii", "phi", "secrets", "financial")
VIOLATIONS_DDL = "array<struct<category:string,type:string,severity:string,start:int,end:int>>"

__all__ = ["detect", "detected", "entities", "scan", "redact", "gate", "full_scan", "luhn_valid",
           "pii_violations", "phi_violations", "secret_violations", "financial_violations"]

# Literals without which a pattern cannot match.
LITERALS = {
    "email": ["@"],
    "api_key_openai": ["sk-"],
    "api_key_aws": ["AKIA"],
    "private_key": ["PRIVATE KEY-----"],
    "jwt_token": [".eyJ"],
    "generic_secret": [":", "="],
}
SCAN = [Detector(name, pattern, name.startswith("credit_card_"), name) for name, pattern in P.PII]
KINDS = {
    "ssn": Detector("ssn", P.PATTERN["ssn"], gate="ssn"),
    "email": Detector("email", P.PATTERN["email"], gate="email"),
    "credit_card": Detector("credit_card", P.CARD, luhn=True, gate="credit_card"),
    "phone": Detector("phone", P.PATTERN["phone_us"], gate="phone_us"),
    "iban": Detector("iban", P.IBAN, gate="iban"),
}
KINDS |= {name: Detector(name, pattern, gate=name) for name, pattern, _ in P.SECRETS}
SEVERITY = P.PII_SEVERITY | {name: severity for name, _, severity in P.SECRETS}
SEVERITY |= {"iban": "high"}

# Kinds of each category, in reporting order.
REPORT = {
    "pii": ["ssn", "email", "credit_card", "phone"],
    "phi": ["ssn", "email", "credit_card", "phone"],
    "secrets": [name for name, _, _ in P.SECRETS],
    "financial": ["credit_card", "iban"],
}


def _spans(text: Column, detectors: list[Detector]) -> Column:
    """Spans per detector, each cheap test made once per text.

    One pass finds the stretches that may hold numbers. They are short, so that each number pattern
    is tried on them first, and on the whole text only if it is there.
    """
    wanted = {d.gate for d in detectors}
    gates = {"iban": text.rlike("[0-9]{7}")}
    for name, literals in LITERALS.items():
        tests = [F.contains(text, F.lit(literal)) for literal in literals]
        gates[name] = tests[0] if len(tests) == 1 else tests[0] | tests[1]
    cores = {name: core for name, core in P.CORES.items() if name in wanted}
    if not cores:
        return spans_by_detector(text, detectors, gates)

    def found(stretches):
        numbers = {name: (stretches != "") & stretches.rlike(core) for name, core in cores.items()}
        return spans_by_detector(text, detectors, gates | numbers)

    stretches = F.regexp_extract_all(text, F.lit(P.CANDIDATE), F.lit(0))
    return bind(F.array_join(stretches, "x"), found)


def detect(text: Column, name: str) -> Column:
    """Spans of one kind of personal data, before overlaps are removed."""
    return F.element_at(_spans(text, [d for d in SCAN if d.name == name]), 1)


def detected(text: Column) -> Column:
    """Would ``scan`` find anything? Skips overlaps and redaction, which cannot change that."""
    return F.exists(_spans(text, SCAN), lambda spans: F.size(spans) > 0)


def _kept(text: Column) -> Column:
    return remove_overlaps(F.flatten(_spans(text, SCAN)))


def _shown(kept: Column) -> Column:
    return F.transform(
        kept,
        lambda e: F.struct(
            e["type"].alias("type"),
            e["value"].alias("value"),
            e["start"].alias("start"),
            e["end"].alias("end"),
        ),
    )


def entities(text: Column) -> Column:
    """The entities of ``scan`` without the work of redaction."""
    return _shown(_kept(text))


def scan(text: Column) -> Column:
    """struct(detected, entities, redacted_text) over the seven personal-data patterns."""
    return bind(
        _kept(text),
        lambda kept: F.struct(
            (F.size(kept) > 0).alias("detected"),
            _shown(kept).alias("entities"),
            redact_spans(text, kept).alias("redacted_text"),
        ),
    )


def redact(text: Column) -> Column:
    return scan(text)["redacted_text"]


def _violations(text: Column, categories) -> Column:
    """Violations of the categories, in the fixed category and kind order; overlaps are kept."""
    reported = [(c, kind) for c in CATEGORIES if c in categories for kind in REPORT[c]]
    if not reported:
        return F.array().cast(VIOLATIONS_DDL)
    kinds = list(dict.fromkeys(kind for _, kind in reported))
    personal = [kinds.index(kind) for kind in REPORT["phi"] if kind in kinds]

    def collect(spans, medical):
        parts = []
        for category, kind in reported:
            found = F.get(spans, kinds.index(kind))
            if category == "phi":
                found = F.when(medical, found)
            parts.append(
                F.struct(
                    F.lit(category).alias("category"),
                    F.lit(f"phi_{kind}" if category == "phi" else kind).alias("type"),
                    F.lit("critical" if category == "phi" else SEVERITY[kind]).alias("severity"),
                    found.alias("spans"),
                )
            )

        def violations(part):
            return F.transform(
                F.coalesce(part["spans"], F.array()),
                lambda s: F.struct(
                    part["category"].alias("category"),
                    part["type"].alias("type"),
                    part["severity"].alias("severity"),
                    s["start"].alias("start"),
                    s["end"].alias("end"),
                ),
            )

        return F.flatten(F.transform(F.array(*parts), violations)).cast(VIOLATIONS_DDL)

    def with_context(spans):
        if "phi" not in categories:
            return collect(spans, None)
        # The word test runs only for texts that hold personal data at all.
        private = F.lit(False)
        for i in personal:
            private = private | (F.size(F.get(spans, i)) > 0)
        medical = F.when(private, F.lower(text).rlike(P.MEDICAL_RE)).otherwise(F.lit(False))
        return bind(medical, lambda m: collect(spans, m))

    return bind(_spans(text, [KINDS[kind] for kind in kinds]), with_context)


def pii_violations(text: Column) -> Column:
    """Social security, e-mail, generic card and phone hits, in that order, overlaps kept."""
    return _violations(text, ("pii",))


def phi_violations(text: Column) -> Column:
    """Personal data in a text that also holds a medical term."""
    return _violations(text, ("phi",))


def secret_violations(text: Column) -> Column:
    """Keys, tokens and passwords."""
    return _violations(text, ("secrets",))


def financial_violations(text: Column) -> Column:
    """Generic cards and international account numbers."""
    return _violations(text, ("financial",))


def full_scan(text: Column, categories=CATEGORIES) -> Column:
    """struct(detected, violations, categories), parts in the order pii, phi, secrets, financial."""
    return bind(
        _violations(text, tuple(categories)),
        lambda v: F.struct(
            (F.size(v) > 0).alias("detected"),
            v.alias("violations"),
            F.array_distinct(F.transform(v, lambda x: x["category"])).alias("categories"),
        ),
    )


def gate(text: Column, redacted: bool = True) -> Column:
    """struct(blocked, violations, redacted_text): blocked when scan and full scan both hit.

    Without ``redacted`` the last field and the work for it are left out.
    """

    def judged(scanned):
        found = F.when(scanned["detected"], _violations(text, CATEGORIES)).otherwise(
            F.array().cast(VIOLATIONS_DDL)
        )

        def fields(v):
            blocked = F.size(v) > 0
            out = [blocked.alias("blocked"), v.alias("violations")]
            if redacted:
                out.append(F.when(blocked, scanned["redacted_text"]).alias("redacted_text"))
            return F.struct(*out)

        return bind(found, fields)

    scanned = scan(text) if redacted else F.struct(detected(text).alias("detected"))
    return bind(scanned, judged)
