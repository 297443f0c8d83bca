"""Plain versions of the operators' contracts, without Spark."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text: str | None) -> frozenset:
    w = WORD.findall((text or "").translate(LOWER))
    return frozenset(tuple(w[k : k + 5]) for k in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def components(rows: list[tuple[int | None, str | None]]) -> list[tuple[int, int | None, int]]:
    """(set size, least id, links) for each row, from all pairs of rows."""
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    links = [0] * len(rows)
    holders = defaultdict(list)
    for i, s in enumerate(sets):
        near = {j for x in s for j in holders[x]}
        for j in near:
            both = len(s & sets[j])
            if 100 * both >= 75 * (len(s) + len(sets[j]) - both):
                links[i] += 1
                links[j] += 1
                root[find(i)] = find(j)
        for x in s:
            holders[x].append(i)
    least: dict[int, int] = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(least.get(find(i), d), d)
    return [(len(sets[i]), least.get(find(i)), links[i]) for i in range(len(rows))]


PII = (("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"), ("card", r"[0-9]([\x20-]?[0-9])+"), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]"))


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        x = int(c) * (1 + i % 2)
        total += x - 9 * (x > 9)
    return total % 10 == 0


def base_spans(text: str | None) -> list[tuple[int, int, int, str]]:
    out = []
    for rank, (kind, pattern) in enumerate(PII):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            ok = {"email": True, "ip": kind == "ip" and all(int(p) <= 255 for p in m[0].split(".")), "card": 12 <= len(digits) <= 19 and luhn(digits), "phone": 9 <= len(digits) <= 15}[kind]
            if ok:
                out.append((m.start(), rank, m.end(), kind))
    return sorted(out)


def joined(spans: list[tuple[int, int, int, str]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for a, _, b, k in spans)


def sha(data: bytes | str) -> str:
    return hashlib.sha256(data.encode("utf-8") if isinstance(data, str) else data).hexdigest()


def payload(text: str | None) -> bytes:
    data = (text or "").encode()
    return data + b"\0" * (-len(data) % 64 if data else 64)


def crc(data: bytes) -> int:
    return zlib.crc32(data)


def targets(sizes: dict[str | None, int]) -> dict[str | None, float]:
    """Resharing by weight, round by round."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    left, full = 1.5 * sum(sizes.values()), {}
    while True:
        open_ = [s for s in names if s not in full]
        if not open_:
            return full
        total = sum(weight[s] for s in open_)
        share = {s: left * weight[s] / total for s in open_}
        over = [s for s in open_ if share[s] >= 2 * sizes[s]]
        if not over:
            return full | share
        for s in over:
            full[s] = 2.0 * sizes[s]
            left -= full[s]
