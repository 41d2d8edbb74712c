"""Plain Python versions of the contracts, over lists of rows; used to check the Spark queries."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import defaultdict

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
BLANK = " \t\n\x0b\x0c\r"


def sha(text: str | bytes) -> str:
    return hashlib.sha256(text.encode() if isinstance(text, str) else text).hexdigest()


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(UPPER))


def decontaminate(docs, benchmark):
    windows = defaultdict(set)
    for item, text in benchmark:
        own = words(text)
        if item is not None and own:
            n = min(13, len(own))
            for i in range(len(own) - n + 1):
                windows[tuple(own[i : i + n])].add(str(item))
    lengths = {len(w) for w in windows}
    out = []
    for doc, text in docs:
        own, hit, items = words(text), set(), set()
        for n in lengths:
            for i in range(len(own) - n + 1):
                found = windows.get(tuple(own[i : i + n]))
                if found:
                    hit.update(range(i, i + n))
                    items |= found
        out.append((doc, len(own), len(hit), len(items), sha(",".join(sorted(items))), bool(hit) and 20 * len(hit) >= len(own)))
    return out


def line_dedup(docs):
    def key(line):
        core = line.strip(BLANK)
        return core.translate(UPPER) if len(core) >= 20 else None

    held = defaultdict(set)
    for doc, text in docs:
        if doc is not None:
            for line in (text or "").split("\n"):
                if key(line):
                    held[key(line)].add(doc)
    out = []
    for doc, text in docs:
        lines = (text or "").split("\n")
        kept = [x for x in lines if doc is None or not key(x) or len(held[key(x)]) < 3 or max(held[key(x)]) == doc]
        out.append((doc, len(lines), len(lines) - len(kept), sha("\n".join(kept))))
    return out


PATTERNS = {
    "assign": (re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""), 2, 6),
    "access": (re.compile(r"AKIA[A-Z0-9]+"), 0, 20),
    "hex": (re.compile(r"[0-9a-f]+"), 0, 24),
    "weakid": (re.compile(r"(?i:client|account|user|access_?key)[_-]?(?i:id|name)[\"']?\x20*[:=]\x20*[\"']?[A-Za-z0-9._@-]+"), 0, 10),
    "weakkey": (re.compile(r"(?<![A-Za-z0-9+/_-])(?=[A-Za-z0-9+/_-]*[0-9])(?=[A-Za-z0-9+/_-]*[A-Z])(?=[A-Za-z0-9+/_-]*[a-z])[A-Za-z0-9+/_-]+"), 0, 32),
    "endpoint": (re.compile(r"[a-z][a-z0-9+.-]{1,20}://[^\s\"'<>]+", re.A), 0, 8),
}
ROLE = {"assign": "secret", "access": "id", "hex": "secret", "weakid": "id", "weakkey": "secret", "endpoint": "endpoint"}


def secrets(docs, scope=400):
    out, order = [], list(PATTERNS)
    for doc, text in docs:
        found = [(m.start(), order.index(k), k, m.end()) for k, (p, g, least) in PATTERNS.items() for m in p.finditer(text or "") if len(m[g]) >= least]

        def near(a, roles):
            return any(
                ROLE[b[2]] in roles and (0 <= a[0] - b[3] <= scope or 0 <= b[0] - a[3] <= scope) for b in found
            )

        base = [a for a in found if a[1] < 3]
        extra = [
            a
            for a in found
            if (a[2] == "weakkey" and near(a, {"id", "endpoint"})) or (a[2] == "weakid" and near(a, {"secret"}))
            or (a[2] == "endpoint" and near(a, {"id"}) and near(a, {"secret"}))
        ]
        spans = [",".join(f"{k}:{s}:{e}" for s, _, k, e in sorted(x)) for x in (base, base + extra)]
        out.append((doc, *(sum(a[2] == k for a in base) for k in order[:3]), sha(spans[0]), spans[1]))
    return out


def crc(text):
    return zlib.crc32((text or "").encode())


def shingle_set(text, size=2):
    own = [w for w in re.split(r"[\x20\x09-\x0D]+", (text or "").translate(UPPER)) if w]
    return {tuple(own)} if 0 < len(own) < size else {tuple(own[i : i + size]) for i in range(len(own) - size + 1)}


def roots(nodes, links):
    parent = {n: n for n in nodes}

    def find(n):
        while parent[n] != n:
            parent[n] = parent[parent[n]]
            n = parent[n]
        return n

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def near_duplicates(docs, percent=80, size=2):
    sets = [(d, shingle_set(t, size)) for d, t in docs]
    inside = defaultdict(list)
    links = set()
    for i, (_, s) in enumerate(sets):
        shared = defaultdict(int)
        for x in s:
            for j in inside[x]:
                shared[j] += 1
            inside[x].append(i)
        for j, n in shared.items():
            a, b = sets[i][0], sets[j][0]
            if None not in (a, b) and 100 * n >= percent * (len(s) + len(sets[j][1]) - n):
                links.add((a, b))
    root = roots({d for d, _ in docs if d is not None}, links)
    return [(d, len(s), root.get(d), d is None or root[d] == d) for d, s in sets]


def remove_repeats(docs, span=100):
    first, out = {}, []
    rows = sorted({(d, t or "") for d, t in docs}, key=lambda r: (r[0] is not None, r[0] or 0))
    for d, t in rows:
        data = t.encode()
        for p in range(len(data) - span + 1):
            first.setdefault(data[p : p + span], (d, p))
    for d, t in docs:
        data = (t or "").encode()
        gone = bytearray(len(data))
        for p in range(len(data) - span + 1):
            if first[data[p : p + span]] != (d, p):
                gone[p : p + span] = b"\1" * span
        runs = sum(1 for i, g in enumerate(gone) if g and not (i and gone[i - 1]))
        out.append((d, len(data), sum(gone), runs, sha(bytes(b for b, g in zip(data, gone, strict=True) if not g))))
    return out
