"""Plain Python versions of the contracts, row by row."""

import hashlib
import re


def sha(data) -> str:
    return hashlib.sha256(data if isinstance(data, bytes) else data.encode()).hexdigest()


def lower_ascii(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def listed(spans):
    return ",".join(f"{kind}:{start}:{end}" for start, _, kind, end in sorted(spans))


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def personal(text):
    patterns = {
        "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
        "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        "card": r"[0-9]([\x20-]?[0-9])+",
        "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    }
    found = []
    for rank, (kind, pattern) in enumerate(patterns.items()):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m.group())
            good = {
                "email": True,
                "ip": kind == "ip" and all(int(p) <= 255 for p in m.group().split(".")),
                "card": 12 <= len(digits) <= 19 and luhn(digits),
                "phone": 9 <= len(digits) <= 15,
            }[kind]
            if good:
                found.append((m.start(), rank, kind, m.end()))
    return sorted(found)


def secrets(text):
    names = r"password|passwd|secret|token|api_?key"
    either = "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in names)
    patterns = {
        "assign": rf"({either})[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
        "access": r"(AKIA)([A-Z0-9]+)",
        "hex": r"()([0-9a-f]+)",
    }
    least = {"assign": 12, "access": 14, "hex": 16}
    return sorted(
        (m.start(), rank, kind, m.end())
        for rank, (kind, pattern) in enumerate(patterns.items())
        for m in re.finditer(pattern, text or "")
        if len(m.group(2)) >= least[kind]
    )


def words(text):
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", lower_ascii(text))


def contamination(texts, items):
    windows = {}
    for item, text in items:
        w = words(text)
        k = min(13, len(w))
        for at in range(len(w) - k + 1 if w else 0):
            windows.setdefault(tuple(w[at : at + k]), set()).add(str(item))
    out = []
    for text in texts:
        w, hit, found = words(text), set(), set()
        for k in {len(g) for g in windows}:
            for at in range(len(w) - k + 1):
                if names := windows.get(tuple(w[at : at + k])):
                    found |= names
                    hit |= set(range(at, at + k))
        bad = len(hit) > 0 and 20 * len(hit) >= len(w)
        out.append((len(w), len(hit), len(found), sha(",".join(sorted(found))), bad))
    return out


def fingerprint(text):
    from xxhash import xxh64_intdigest

    w = re.findall("[^\x20\x09-\x0d]+", lower_ascii(text))
    if not w:
        return 0
    hashes = [
        xxh64_intdigest(" ".join(w[i : i + 4]).encode(), 42) for i in range(max(1, len(w) - 3))
    ]
    bits = [sum(h >> b & 1 for h in hashes) * 2 > len(hashes) for b in range(64)]
    return sum(1 << b for b, on in enumerate(bits) if on)


def components(ids, prints):
    parent = list(range(len(ids)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(ids)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 4:
                parent[root(i)] = root(j)
    least = {}
    for i, doc in enumerate(ids):
        r = root(i)
        if doc is not None:
            least[r] = min(doc, least.get(r, doc))
    return [least.get(root(i)) for i in range(len(ids))]


def repeats(rows):
    """Per row in the order given: n_bytes, n_removed, n_spans and digest of what is kept."""
    seen, out = set(), []
    for text in rows:
        data = (text or "").encode()
        gone = [False] * len(data)
        for at in range(len(data) - 99):
            string = data[at : at + 100]
            if string in seen:
                gone[at : at + 100] = [True] * 100
            seen.add(string)
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        kept = bytes(b for b, g in zip(data, gone, strict=True) if not g)
        out.append((len(data), sum(gone), spans, sha(kept)))
    return out
