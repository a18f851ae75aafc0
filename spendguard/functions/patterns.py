"""Patterns and word lists of the content scanner.

The detection patterns, medical terms and severities below are fixed values: results must
agree with them. ``\\b`` and ``\\s`` are written out because the JVM's ``\\b`` follows Unicode
letters and its ``\\s`` knows ASCII blanks only, while the scanner needs ASCII word edges and
Unicode blanks.
"""

WORD = "[A-Za-z0-9_]"
EDGE = f"(?:(?<={WORD})(?!{WORD})|(?<!{WORD})(?={WORD}))"
SPACES = (
    r"\t\n\x0B\f\r \x{00A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}\x{FEFF}"
)

# Fixed values: (type, pattern) in scan order.
_PII = [
    ("ssn", r"\b\d{3}-\d{2}-\d{4}\b"),
    ("credit_card_visa", r"\b4\d{3}[- ]?\d{4}[- ]?\d{4}[- ]?\d{4}\b"),
    ("credit_card_mastercard", r"\b5[1-5]\d{2}[- ]?\d{4}[- ]?\d{4}[- ]?\d{4}\b"),
    ("credit_card_amex", r"\b3[47]\d{2}[- ]?\d{6}[- ]?\d{5}\b"),
    ("credit_card_discover", r"\b6(?:011|5\d{2})[- ]?\d{4}[- ]?\d{4}[- ]?\d{4}\b"),
    ("email", r"\b[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}\b"),
    ("phone_us", r"\b(?:\+?1[-.\s]?)?(?:\(?\d{3}\)?[-.\s]?)\d{3}[-.\s]?\d{4}\b"),
]
_CARD = r"\b\d{4}[\s-]?\d{4}[\s-]?\d{4}[\s-]?\d{4}\b"
# Fixed values: (type, pattern, severity).
_SECRETS = [
    ("api_key_openai", r"sk-[a-zA-Z0-9]{20,}", "critical"),
    ("api_key_aws", r"AKIA[0-9A-Z]{16}", "critical"),
    ("private_key", r"-----BEGIN (?:RSA |EC |DSA )?PRIVATE KEY-----", "critical"),
    ("jwt_token", r"eyJ[A-Za-z0-9_-]{10,}\.eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}", "high"),
    (
        "generic_secret",
        r"""(?i)(?:password|api_key|apikey|secret|token|bearer)\s*[:=]\s*["']?([A-Za-z0-9_\-/.]{8,})["']?""",
        "critical",
    ),
]
_IBAN = r"\b[A-Z]{2}\d{2}[A-Z0-9]{4}\d{7}[A-Z0-9]{0,16}\b"

# Words that turn personal data into health data.
MEDICAL_TERMS = [
    "diabetes", "hiv", "aids", "cancer", "tumor", "disease", "medication", "diagnosis",
    "treatment", "surgery", "prescription", "patient", "doctor", "hospital", "clinic",
    "medical record", "insulin", "prozac", "chemotherapy", "depression", "anxiety", "bipolar",
    "schizophrenia", "hepatitis", "tuberculosis", "epilepsy", "asthma", "arthritis", "alzheimer",
]

# Severity of each kind of personal data.
PII_SEVERITY = {"ssn": "critical", "email": "high", "credit_card": "critical", "phone": "medium"}


def jvm(pattern: str, edges: bool = True) -> str:
    """Rewrite the portable pattern for ``java.util.regex``; without ``edges`` it matches wherever
    it does with them, and in more places."""
    head = tail = ""
    body = pattern
    if body.endswith(r"\b"):  # every pattern here ends on a word character
        body, tail = body[:-2], f"(?!{WORD})"
    if body.startswith(r"\b"):
        body = body[2:]
        starts_on_word = body.startswith((r"\d", "[A-Z]{2}")) or body[0].isalnum()
        head = f"(?<!{WORD})" if starts_on_word else EDGE
    # The local part of an address never holds '@', so it need not give characters back.
    body = body.replace("[A-Za-z0-9._%+-]+@", "[A-Za-z0-9._%+-]++@")
    body = body.replace(r"[-.\s]", f"[-.{SPACES}]").replace(r"[\s-]", f"[{SPACES}-]")
    body = body.replace(r"\s*", f"[{SPACES}]*")
    return head + body + tail if edges else body


def re2(pattern: str) -> str:
    """The same pattern for RE2, used by the checking SQL (its ``\\b`` is ASCII already)."""
    body = pattern.replace(r"[-.\s]", f"[-.{SPACES}]").replace(r"[\s-]", f"[{SPACES}-]")
    return body.replace(r"\s*", f"[{SPACES}]*")


PII = [(name, jvm(p)) for name, p in _PII]
CARD = jvm(_CARD)
SECRETS = [(name, jvm(p), severity) for name, p, severity in _SECRETS]
IBAN = jvm(_IBAN)
PATTERN = dict(PII)

#: Card, phone and social security numbers lie in stretches of digits, brackets and separators, ten
#: at least. Within these stretches the patterns without edges tell which of them to look for.
CANDIDATE = f"[0-9+(][0-9+().{SPACES}-]{{8,}}[0-9]"
CORES = {name: jvm(p, edges=False) for name, p in _PII if name != "email"} | {"credit_card": jvm(_CARD, edges=False)}

PII_RE2 = [(name, re2(p)) for name, p in _PII]
CARD_RE2 = re2(_CARD)
SECRETS_RE2 = [(name, re2(p), severity) for name, p, severity in _SECRETS]
IBAN_RE2 = re2(_IBAN)
MEDICAL_RE = "|".join(MEDICAL_TERMS)
