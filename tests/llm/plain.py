"""Plain restatements of the operators for small inputs."""

from __future__ import annotations

import hashlib
import re
import zlib

import xxhash

SF_DIR = "/root/testdata/sf0.001"
WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall((text or "").encode())


def sha(data):
    return hashlib.sha256(data if isinstance(data, bytes) else data.encode()).hexdigest()


def substring(rows, window):
    """[(doc_id, words, removed, kept words)] in the order of the rows."""
    first = {}
    for doc, text in rows:
        w = words(text)
        for i in range(len(w) - window + 1 if doc is not None else 0):
            key = hashlib.md5(b" ".join(w[i : i + window])).digest()
            first[key] = min(first.get(key, doc), doc)
    out = []
    for doc, text in rows:
        w = words(text)
        keep = [True] * len(w)
        for i in range(len(w) - window + 1 if doc is not None else 0):
            if first[hashlib.md5(b" ".join(w[i : i + window])).digest()] < doc:
                keep[i : i + window] = [False] * window
        out.append((doc, len(w), len(w) - sum(keep), b" ".join(x for x, k in zip(w, keep) if k)))
    return out


def line_windows(rows, window=3):
    """[(doc_id, lines, removed, new text)] in the order of the rows."""
    first = {}
    for doc, text in rows:
        lines = (text or "").split("\n")
        for i in range(len(lines) - window + 1 if doc is not None else 0):
            key = tuple(lines[i : i + window])
            first[key] = min(first.get(key, (doc, i)), (doc, i))
    out = []
    for doc, text in rows:
        lines = (text or "").split("\n")
        gone = set()
        for i in range(len(lines) - window + 1 if doc is not None else 0):
            if first[tuple(lines[i : i + window])] < (doc, i):
                gone |= set(range(i, i + window))
        kept = "\n".join(x for i, x in enumerate(lines) if i not in gone) if gone else text
        out.append((doc, len(lines), len(gone), kept))
    return out


def fingerprint(text):
    w = WORD.findall((text or "").encode().lower())
    shingles = [b" ".join(w[i : i + 4]) for i in range(len(w) - 3)] or ([b" ".join(w)] if w else [])
    hashes = [xxhash.xxh64(s, seed=42).intdigest() for s in shingles]
    return sum(1 << k for k in range(64) if 2 * sum(h >> k & 1 for h in hashes) > len(hashes))


def linked(pairs, ids):
    """Smallest id reachable from each id."""
    up = {i: i for i in ids}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in pairs:
        a, b = root(a), root(b)
        up[max(a, b)] = min(a, b)
    return {i: root(i) for i in ids}


def near_groups(rows, bits=4):
    """[(doc_id, fingerprint, component)] in the order of the rows."""
    prints = [fingerprint(t) for _, t in rows]
    least = {}
    for (doc, _), p in zip(rows, prints):
        if doc is not None:
            least[p] = min(least.get(p, doc), doc)
    codes = sorted(least)
    pairs = [(a, b) for a in codes for b in codes if a < b and (a ^ b).bit_count() <= bits]
    group = linked(pairs, codes)
    smallest = {}
    for p in codes:
        smallest[group[p]] = min(smallest.get(group[p], least[p]), least[p])
    return [(doc, p, smallest[group[p]] if p in group else None) for (doc, _), p in zip(rows, prints)]


def damaged(rows):
    """rows: (conv_id, turn, role, text); conversations after damage as {conv_id: [(turn, role, text)]}, each in its order."""
    out = {}
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if kind == 1:
            text = ""
        elif kind == 2:
            text = re.sub("[.!?]", "", text)
        elif kind == 4:
            role = "user"
        out.setdefault(conv, []).extend([(turn, role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1))
    for listed in out.values():
        listed.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2][:32].encode(), hashlib.md5(r[2].encode()).hexdigest()))
    return out


def repaired(rows):
    """(gaps, blank, duplicate, truncated, illegal, cost, audit, digest) of one conversation, by search over rows and states."""
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    seen, fault = set(), []
    for _, role, text in rows:
        bare = text.strip(" \t\n\x0b\x0c\r")
        fault.append("blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else "")
        seen.add((role, text))
    # states: e nothing yet, s, u, a; the best so far is (cost, audit, lines)
    follow = {"e": "su", "s": "u", "u": "a", "a": "u"}
    full = {"u": "user", "a": "assistant"}

    def put(best, state, cost, audit, lines):
        if state not in best or (cost, audit) < best[state][:2]:
            best[state] = (cost, audit, lines)

    def grown(best):
        for _ in range(3):
            for state, (cost, audit, lines) in list(best.items()):
                for r in follow[state]:
                    if r in full:
                        put(best, r, cost + 2, audit + "I", lines + [f"{full[r]}:"])
        return best

    best = grown({"e": (0, "", [])})
    for (_, role, text), f in zip(rows, fault):
        after = {}
        for state, (cost, audit, lines) in best.items():
            put(after, state, cost + 3, audit + "D", lines)
            if f not in ("blank", "duplicate"):
                for r in follow[state]:
                    if r == role[:1]:
                        put(after, r, cost + (f == "truncated"), audit + "K", lines + [f"{role}:{text}"])
                    if r in full:
                        put(after, r, cost + 2 + (f == "truncated"), audit + "R", lines + [f"{full[r]}:{text}"])
        best = grown(after)
    cost, audit, lines = min((best[s] for s in "ea" if s in best), key=lambda x: x[:2])
    return (gaps, fault.count("blank"), fault.count("duplicate"), fault.count("truncated"), illegal, cost, audit, sha("\n".join(lines)))
