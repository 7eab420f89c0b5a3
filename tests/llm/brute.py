"""Plain Python versions of the operators, for small tables."""

from __future__ import annotations

import hashlib
import heapq
import itertools
import re
import zlib
from collections import Counter, defaultdict

import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def groups(nodes, linked):
    """Smallest reachable node of every node, ``linked(a, b)`` for every pair."""
    nodes = sorted(nodes)
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for i, a in enumerate(nodes):
        for b in nodes[i + 1 :]:
            if linked(a, b):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {n: find(n) for n in nodes}


def simhash(text):
    lower = (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    words = WORD.findall(lower)
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def quality(docs):
    """[(id, metrics..., kept)] for (id, text, host); each row on its own."""
    lines_of, docs_of = defaultdict(set), defaultdict(set)
    normal = lambda line: " ".join(WORD.findall(line)).lower()
    for _, text, host in docs:
        docs_of[host].add(text or "")
        for line in (text or "").split("\n"):
            if WORD.search(line):
                lines_of[host, normal(line)].add(text or "")
    out = []
    for i, text, host in docs:
        text = text or ""
        words = WORD.findall(text)
        seen, dup, removed = set(), 0, 0
        for line in text.split("\n"):
            if WORD.search(line):
                dup += line in seen
                seen.add(line)
                n = len(lines_of[host, normal(line)])
                if n > 10 and 100 * n > len(docs_of[host]):
                    removed += len(WORD.findall(line))
        windows = list(zip(words, words[1:], words[2:], strict=False))
        count = Counter(windows)
        covered = {p for k, w in enumerate(windows) if count[w] > 1 for p in (k, k + 1, k + 2)}
        failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
        kept = not failed and len(words) - removed >= 0.5 * len(words)
        out.append((i, len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered), failed, kept))
    return out


def without_frequent_lines(docs):
    """{id: text} for (id, text, host): frequent lines of a host go, but for its text of the least hash."""
    holders, hosts = defaultdict(set), defaultdict(set)
    normal = lambda line: " ".join(WORD.findall(line)).lower()
    least = lambda text: xxhash.xxh64_intdigest(text.encode(), 42) + (1 << 63) & (1 << 64) - 1
    for _, text, host in docs:
        hosts[host].add(text or "")
        for line in (text or "").split("\n"):
            if WORD.search(line):
                holders[host, normal(line)].add(text)
    common = {k: min(t, key=least) for k, t in holders.items() if len(t) > 10 and 100 * len(t) > len(hosts[k[0]])}
    return {i: "\n".join(x for x in text.split("\n") if common.get((host, normal(x)), text) == text) for i, text, host in docs if text is not None}


def shingles(text, width=5):
    words = WORD.findall((text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")))
    return {tuple(words[i : i + width]) for i in range(len(words) - width + 1)} or {tuple(words)}


def near_groups(texts):
    """{id: smallest id reachable} over Jaccard similarities of 0.8 or more."""
    sets = {i: shingles(t) for i, t in texts.items()}
    return groups(sets, lambda a, b: len(sets[a] & sets[b]) * 5 >= 4 * len(sets[a] | sets[b]))


def line_keys(line, every=False):
    """Templates of one line as tuples."""
    tokens = re.sub("[0-9]+", "0", " ".join(WORD.findall(line))).split(" ")
    n = len(tokens)
    if n < 3:
        return [(n, tuple(tokens))] if every and tokens[0] else []
    keys, w = [(n, tuple(tokens))], int(n * 0.2 + 1e-9)
    if w:
        rest = tokens[2:]
        runs = [tuple(rest[i : i + w]) for i in range(0, len(rest), w)]
        keys += [(n, tuple(tokens[:2]), b, *runs[:b], *runs[b + 1 :]) for b in range(len(runs))]
    return keys


def clean_lines(docs, every=False):
    """{(id, text): cleaned text} for (id, text)."""
    holders = defaultdict(set)
    for i, text in docs:
        for line in (text or "").split("\n"):
            for k in line_keys(line, every):
                holders[k].add(i)
    out = {}
    for i, text in docs:
        if text is None:
            out[i, text] = None
            continue
        stay = []
        for line in text.split("\n"):
            hit = [holders[k] for k in line_keys(line, every) if len(holders[k]) >= (2 if every and k[0] > 50 else 3)]
            if all(min(x for x in h if x is not None) == i for h in hit):
                stay.append(line)
        out[i, text] = "\n".join(stay)
    return out


def targets(sizes):
    """{source: target} for {source: size}: weights 1, 2, 3 in order, null last, stopped at three times the size."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: 1 + i % 3 for i, s in enumerate(order)}
    full, total = set(), sum(sizes.values())
    while True:
        free = total - sum(3 * sizes[s] for s in full)
        share = sum(weight[s] for s in order if s not in full)
        over = {s for s in order if s not in full and free * weight[s] / share > 3 * sizes[s]}
        if not over:
            return {s: 3.0 * sizes[s] if s in full else free * weight[s] / share for s in order}
        full |= over


BLANKS = " \t\n\x0b\x0c\r"


def damage(rows):
    """Rows (conv, turn, role, text) with the faults that the crc32 of conv:turn plants."""
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        out += [(conv, turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    return out


def ordered(rows):
    """Rows of one conversation in order."""
    same = lambda r: hashlib.md5(f"{len(r[2])}:{r[2]}{r[3]}".encode()).hexdigest()
    return sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, same(r)))


def repaired(rows):
    """(gaps, blank, duplicate, truncated, illegal, cost, audit, sha256) of one conversation, by Dijkstra over all edits."""
    rows = ordered(rows)
    seen, faults = set(), []
    for _, _, role, text in rows:
        end = text.rstrip(BLANKS)
        fault = "blank" if not end else "duplicate" if (role, text) in seen else "truncated" if end[-1] not in ".!?" else None
        seen.add((role, text))
        faults.append(fault)
    turns = {r[1] for r in rows if r[1] is not None}
    gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
    pairs = [a[2][:1] + b[2][:1] for a, b in zip(rows, rows[1:], strict=False)]
    # (cost, audit, row, place in the pattern, repaired lines): cheapest first, then ASCII-least
    heap, done = [(0, "", 0, 0, ())], set()
    while True:
        cost, audit, at, state, lines = heapq.heappop(heap)
        if at == len(rows) and state in (0, 3):
            digest = hashlib.sha256("\n".join(lines).encode()).hexdigest()
            return (gaps, *[faults.count(f) for f in ("blank", "duplicate", "truncated")], sum(p not in ("su", "ua", "au") for p in pairs), cost, audit, digest)
        if (at, state) in done:
            continue
        done.add((at, state))
        new, after = ("assistant", 3) if state == 2 else ("user", 2)
        heapq.heappush(heap, (cost + 2, audit + "I", at, after, (*lines, f"{new}:")))
        if at == len(rows):
            continue
        _, _, role, text = rows[at]
        late = faults[at] == "truncated"
        heapq.heappush(heap, (cost + 3, audit + "D", at + 1, state, lines))
        if faults[at] in ("blank", "duplicate"):
            continue
        heapq.heappush(heap, (cost + 2 + late, audit + "R", at + 1, after, (*lines, f"{new}:{text}")))
        legal = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}.get((state, role[:1]))
        if legal is not None:
            heapq.heappush(heap, (cost + late, audit + "K", at + 1, legal, (*lines, f"{role}:{text}")))


def repair(conversations):
    """{conv: row of ``repaired``} for every conv of (conv, turn, role, text)."""
    damaged = damage(conversations)
    return {c: repaired([r for r in damaged if r[0] == c]) for c in {r[0] for r in conversations}}


def hard_negatives(rows, anchor):
    """Sorted (anchor, positive, rank, negative, positive score, negative score) of (id, label, whole numbers)."""
    out = []
    for i, (aid, alabel, a) in enumerate(rows):
        if not anchor(aid):
            continue
        scored = [(-sum(x * y for x, y in zip(a, v, strict=True)), vid, label) for k, (vid, label, v) in enumerate(rows) if k != i and len(v) == len(a)]
        scored.sort(key=lambda s: s[:2])
        for p, pid, _ in [s for s in scored if s[2] == alabel][:5]:
            fits = [(s, vid) for s, vid, label in scored if label != alabel and 80 * -p <= 100 * -s <= 100 * -p]
            out += [(aid, pid, rank, vid, -p, -s) for rank, (s, vid) in enumerate(fits[:5], 1)]
    return sorted(out)


def url_rules(labelled, min_count, min_confidence=0.9, lift=0.01):
    """{(tokens, verdict): confidence} of (tokens, verdict): every combination with one host word, path segment and query key at most."""
    kinds = ("host=", "path=", "query=")
    holders = defaultdict(Counter)
    for tokens, verdict in labelled:
        for size in range(1, len(tokens) + 1):
            for combo in itertools.combinations(sorted(tokens), size):
                if all(sum(t.startswith(k) for t in combo) <= 1 for k in kinds):
                    holders[combo][verdict] += 1
    found = {}
    for combo, verdicts in holders.items():
        for verdict, n in verdicts.items():
            if n >= min_count and n / verdicts.total() >= min_confidence:
                found[combo, verdict] = n / verdicts.total()
    parts = lambda combo: (p for size in range(1, len(combo)) for p in itertools.combinations(combo, size))
    return {(c, v): x for (c, v), x in found.items() if not any(x < found.get((p, v), -1) + lift for p in parts(c))}
