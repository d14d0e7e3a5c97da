"""Plain re-statements of contracts, one text at a time, to hold operators against."""

import hashlib
import math
import re

BASE = {
    "email": re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    "ip": re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    "card": re.compile(r"[0-9]([\x20-]?[0-9])+"),
    "phone": re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
}


def luhn(number: str) -> bool:
    return sum(sum(divmod(int(d) * (1 + i % 2), 10)) for i, d in enumerate(reversed(number))) % 10 == 0


def passes(kind: str, value: str) -> bool:
    digits = re.sub("[^0-9]", "", value)
    if kind == "ip":
        return all(int(p) <= 255 for p in value.split("."))
    if kind == "card":
        return 12 <= len(digits) <= 19 and luhn(digits)
    return kind == "email" or 9 <= len(digits) <= 15


def spans(text: str) -> list[tuple[int, int, str, int]]:
    """(start, number of the kind, kind, end) in order."""
    found = []
    for number, (kind, pattern) in enumerate(BASE.items()):
        found += [(m.start(), number, kind, m.end()) for m in pattern.finditer(text) if passes(kind, m[0])]
    return sorted(found)


def base_sha256(text: str) -> str:
    return hashlib.sha256(",".join(f"{k}:{a}:{b}" for a, _, k, b in spans(text)).encode()).hexdigest()


def disclosed(texts: list[str], text: str) -> str:
    """Base spans and disclosing terms of one of these ASCII texts, as the digest writes them; every pair of an entity and a term is scored."""
    entities = {t: {f"{k}:{t[a:b].lower() if k in ('email', 'ip') else re.sub('[^0-9]', '', t[a:b])}" for a, _, k, b in spans(t)} for t in texts}
    words = {t: {w for w in re.findall("[a-z0-9]+", t.lower()) if re.search("[a-z]", w)} for t in texts}
    n = len(entities)

    def discloses(c: str, w: str) -> bool:
        rate = sum(c in e for e in entities.values()) / n
        both = sum(c in entities[t] and w in words[t] for t in entities)
        p = (both + rate) / (sum(w in x for x in words.values()) + 1)
        return rate < 1 and math.log2(p / rate) / math.log2(1 / rate) >= 0.8

    bad = {w for w in words[text] if any(discloses(c, w) for c in entities[text])}
    base = spans(text)
    terms = [(m.start(), 4, "term", m.end()) for m in re.finditer("[A-Za-z0-9]+", text) if m[0].lower() in bad]
    terms = [x for x in terms if not any(a < x[3] and x[0] < b for a, _, _, b in base)]
    return ",".join(f"{k}:{a}:{b}" for a, _, k, b in sorted(base + terms))
