"""Plain Python versions of the operators, for small tables."""

import hashlib
import math
import re
from collections import Counter, defaultdict

BLANKS = " \t\n\x0b\x0c\r"
ASCII_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def kept_lines(docs, least=10):
    """docs: (doc_id, text); returns the kept text of each row."""
    holders = defaultdict(set)
    for number, text in docs:
        for line in (text or "").split("\n"):
            key = line.strip(BLANKS).translate(ASCII_LOWER)
            if number is not None and len(key) >= least:
                holders[key].add(number)
    out = []
    for number, text in docs:
        lines = (text or "").split("\n")
        keys = [line.strip(BLANKS).translate(ASCII_LOWER) for line in lines]
        kept = [line for line, k in zip(lines, keys) if number is None or k not in holders or number == min(holders[k])]
        out.append((number, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


def shingle_set(text):
    found = words((text or "").translate(ASCII_LOWER))
    if not found:
        return set()
    return {tuple(found[i:i + 5]) for i in range(max(1, len(found) - 4))}


def near_components(docs):
    """docs: {doc_id: text}; returns {doc_id: component}."""
    sets = {k: shingle_set(t) for k, t in docs.items()}
    parent = {k: k for k in docs}

    def root(k):
        while parent[k] != k:
            k = parent[k]
        return k

    seen = defaultdict(list)
    for k in sorted(docs):
        common = Counter(o for s in sets[k] for o in seen[s])
        for s in sets[k]:
            seen[s].append(k)
        for o, n in common.items():
            if 100 * n >= 75 * (len(sets[k]) + len(sets[o]) - n):
                a, b = sorted((root(k), root(o)))
                parent[b] = a
    return {k: root(k) for k in docs}


def rule_counts(text):
    found = words(text)
    windows = [tuple(found[i:i + 3]) for i in range(len(found) - 2)]
    often = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(3)}
    shown = [line for line in (text or "").split("\n") if words(line)]
    return (
        len(found), sum(map(len, found)), len(re.findall(r"[#*$%&|<>]", text or "")), len(shown) - len(set(shown)), len(covered),
        len(found) < 50 or 100 * len(covered) > 50 * len(found),
    )


def exponent(tokens, holds, rising):
    steps = [j for j in range(4097) if holds(j / 4096)]
    return (min(steps, default=4096) if rising else max(steps, default=0)) / 4096


def mixture(docs, target_entropy=None, max_repeats=None, whole=False, block_tokens=1_000_000, seed=17):
    """docs: (doc_id, source, text); returns {(doc_id, source, epoch): (block, place)}."""
    rows = [(d, s, max(1, len(words(t)))) for d, s, t in docs]
    tokens = Counter()
    for _, s, n in rows:
        tokens[s] += n
    total = sum(tokens.values())
    share = {s: n / total for s, n in tokens.items()}

    def entropy(a):
        z = sum(p**a for p in share.values())
        return math.log(z) - a * sum(p**a * math.log(p) for p in share.values()) / z

    def repeats(a):
        ratios = [share[s] ** a / tokens[s] for s in tokens]
        return max(ratios) / min(ratios)

    if target_entropy is not None:
        a = exponent(tokens, lambda x: entropy(x) >= target_entropy * math.log(len(tokens)) - 1e-12, False)
    else:
        a = exponent(tokens, lambda x: repeats(x) <= max_repeats + 1e-12, True)
    z = sum(p**a for p in share.values())
    spend = z / min(share[s] ** a / tokens[s] for s in tokens) if whole else total
    quota = {s: max(round(spend * (share[s] ** a / z)), tokens[s]) if whole else math.floor(spend * (share[s] ** a / z)) for s in tokens}
    blocks = max(1, math.ceil(sum(quota.values()) / block_tokens))
    md5 = lambda x: hashlib.md5(x.encode()).hexdigest()
    taken = []
    for s in tokens:
        epoch = start = 0
        while start < quota[s]:
            for mark, d, n in sorted((md5(f"{seed}|{epoch}|{d}"), d, n) for d, source, n in rows if source == s):
                if start < quota[s]:
                    taken.append((math.floor(start * (blocks / quota[s])), mark, s, d, epoch))
                start += n
            epoch += 1
    out, place = {}, Counter()
    for block, _, s, d, epoch in sorted((b, md5(f"{seed}|{b}|{mark}"), s, d, e) for b, mark, s, d, e in taken):
        place[block] += 1
        out[d, s, epoch] = (block, place[block])
    return out
