"""Plain-Python answers for small inputs."""

import base64
import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import xxhash

SPACE_WORD = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return SPACE_WORD.findall(text or "")


def crc_rest(doc_id, mod):
    return None if doc_id is None else zlib.crc32(str(doc_id).encode()) % mod


def fingerprint(text):
    w = words((text or "").translate(LOWER))
    if not w:
        return 0
    shingles = [" ".join(w[i : i + 3]) for i in range(len(w) - 2)] if len(w) >= 3 else [" ".join(w)]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def simhash_groups(rows, representatives=False):
    """(doc_id, fingerprint, component_id) of each (doc_id, text); or the smallest doc_id of each group."""
    prints = [fingerprint(t) for _, t in rows]
    group = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if bin(prints[i] ^ prints[j]).count("1") <= 2:
                a, b = group[i], group[j]
                group = [min(a, b) if g in (a, b) else g for g in group]
    least = defaultdict(list)
    for g, (i, _) in zip(group, rows):
        least[g].append(i)
    least = {g: min((i for i in ids if i is not None), default=None) for g, ids in least.items()}
    if representatives:
        return sorted(least.values(), key=repr)
    return [(i, f"{p:016x}", least[g]) for g, p, (i, _) in zip(group, prints, rows)]


def contamination(rows, items, window=10):
    per_item = defaultdict(set)
    for name, text in items:
        w = ALNUM_WORD.findall((text or "").translate(LOWER))
        if w:
            n = min(window, len(w))
            per_item[None if name is None else str(name)].update(tuple(w[i : i + n]) for i in range(len(w) - n + 1))
    out = []
    for doc_id, text in rows:
        w = ALNUM_WORD.findall((text or "").translate(LOWER))
        hit, found = set(), set()
        for name, windows in per_item.items():
            for x in windows:
                for i in range(len(w) - len(x) + 1):
                    if tuple(w[i : i + len(x)]) == x:
                        hit.update(range(i, i + len(x)))
                        found.add(name)
        names = sorted(n for n in found if n is not None)
        out.append((doc_id, len(w), len(hit), len(names), hashlib.sha256(",".join(names).encode()).hexdigest(), bool(hit)))
    return out


def mix_targets(rows, weights=(5, 2, 1), epochs=3):
    """Targets by repeated resharing, from (source, size)."""
    size = defaultdict(int)
    for s, n in rows:
        size[s] += n
    names = sorted(size, key=lambda s: (s is None, s or ""))
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    capped, total = {}, sum(size.values())
    while True:
        free = [s for s in names if s not in capped]
        level = (total - sum(capped.values())) / sum(w[s] for s in free) if free else 0
        over = [s for s in free if w[s] * level > epochs * size[s]]
        if not over:
            return {s: capped.get(s, w[s] * level) for s in names}, size
        capped.update({s: epochs * size[s] for s in over})


def line_figures(text):
    t = text or ""
    w = words(t)
    seen_windows = Counter(tuple(w[i : i + 8]) for i in range(len(w) - 7))
    covered = set()
    for i in range(len(w) - 7):
        if seen_windows[tuple(w[i : i + 8])] > 1:
            covered.update(range(i, i + 8))
    seen, dup = set(), 0
    for line in t.split("\n"):
        if words(line):
            dup += line in seen
        seen.add(line)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), dup, len(covered)


def chat_digest(rows):
    """conv_id -> (n_turns, turns_sha256, loss_chars, loss_sha256) from (conv_id, turn, role, text)."""
    convs = defaultdict(list)
    for c, turn, role, text in rows:
        convs[c].append((turn is not None, turn or 0, role or "", text or ""))
    out = {}
    for c, turns in convs.items():
        turns.sort()
        loss = "".join(t for _, _, r, t in turns if r == "assistant")
        full = "".join(f"{r}\n{t}\n" for _, _, r, t in turns)
        out[c] = (len(turns), hashlib.sha256(full.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())
    return out


def repeats(rows, length=100):
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) of rows in corpus order."""
    seen, out = set(), []
    for doc_id, text in rows:
        b = (text or "").encode()
        gone = bytearray(len(b))
        for p in range(len(b) - length + 1):
            g = b[p : p + length]
            if g in seen:
                gone[p : p + length] = b"\1" * length
            seen.add(g)
        kept = bytes(x for x, y in zip(b, gone) if not y)
        out.append((doc_id, len(b), sum(gone), len(re.findall(b"\1+", bytes(gone))), hashlib.sha256(kept).hexdigest()))
    return out


def lm_base(rows):
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score)."""
    counts = Counter()
    for i, t in rows:
        if crc_rest(i, 7) != 2:
            counts.update(words((t or "").translate(LOWER)))
            counts[" "] += 1
    n, v = counts.total(), len(counts)
    out = []
    for i, t in rows:
        own = [*words((t or "").translate(LOWER)), " "]
        base = sum(math.log10((counts.get(x, 0) + 1) / (n + v + 1)) for x in own)
        out.append((i, crc_rest(i, 7) == 2, len(own), sum(x in counts for x in own), n, base))
    return out


def warc_rows(rows):
    """(page_id, payload_bytes, payload_digest, record_type, refers_to)."""
    first = {}
    for i, html in rows:
        if i is not None:
            p = (html or "").encode()
            first[p] = min(i, first.get(p, i))
    out = []
    for i, html in rows:
        p = (html or "").encode()
        to = first.get(p)
        revisit = to is not None and i != to
        digest = base64.b32encode(hashlib.sha1(p).digest()).decode()
        out.append((i, len(p), digest, "revisit" if revisit else "response", to if revisit else None))
    return out
