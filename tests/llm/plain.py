"""The rules of the operators written plainly, row by row, to compare results with."""

import base64
import hashlib
import math
import zlib
import re
import zlib
from collections import Counter

import numpy as np

BLANKS = re.compile(r"[^\x20\x09-\x0D]+")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def groups(ids, links):
    """Least reachable id of each id."""
    parent = {i: i for i in ids}

    def root(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for a, b in links:
        a, b = sorted((root(a), root(b)))
        parent[b] = a
    return {i: root(i) for i in ids}


def repeats(texts, window=35):
    """Words, kept words per text."""
    split = [BLANKS.findall(t or "") for t in texts]
    seen = Counter(
        tuple(w[i : i + window]) for w in split for i in range(len(w) - window + 1)
    )
    kept = []
    for w in split:
        gone = set()
        for i in range(len(w) - window + 1):
            if seen[tuple(w[i : i + window])] > 1:
                gone.update(range(i, i + window))
        kept.append([x for i, x in enumerate(w) if i not in gone])
    return split, kept


def shingles(text, size):
    words = BLANKS.findall(lower(text or ""))
    if not words:
        return set()
    return {tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1))}


def near_copies(rows, size, percent=80):
    """``{key: (set size, component)}`` of ``(key, text)`` rows with distinct keys."""
    sets = {k: shingles(t, size) for k, t in rows}
    keys = [k for k in sets if sets[k]]
    links = []
    for i, a in enumerate(keys):
        for b in keys[:i]:
            x, y = sets[a], sets[b]
            if 100 * min(len(x), len(y)) < percent * max(len(x), len(y)):
                continue
            common = len(x & y)
            if 100 * common >= percent * (len(x) + len(y) - common):
                links.append((a, b))
    found = groups(sets, links)
    return {k: (len(sets[k]), found[k]) for k in sets}


def vector_links(rows, least=0.95):
    """``{key: (links, component)}`` of ``(key, vector)`` rows."""
    good = []
    for k, v in rows:
        if v is not None and all(x is not None and np.isfinite(x) for x in v) and any(v):
            v = np.array(v, float)
            good.append((k, v / np.linalg.norm(v)))
    links = [
        (a, b)
        for i, (a, x) in enumerate(good)
        for b, y in good[:i]
        if len(x) == len(y) and float(x @ y) >= least
    ]
    count = Counter(k for link in links for k in link)
    found = groups([k for k, _ in rows], links)
    return {k: (count[k], found[k]) for k, _ in rows}


def archive_rows(pages):
    """Expected index of ``(id, html)`` rows."""
    bodies = {i: (html or "").encode() for i, html in pages}
    first = {}
    for i in sorted(bodies):
        first.setdefault(bodies[i], i)
    out = {}
    for i, body in bodies.items():
        digest = base64.b32encode(hashlib.sha1(body).digest()).decode()
        again = first[body] != i
        out[i] = (len(body), digest, "revisit" if again else "response", first[body] if again else None)
    return out


def told_words(text):
    return re.findall(r"[a-z0-9\u0080-\U0010ffff]+", lower(text or ""))


def align(query, passage):
    """Best Smith-Waterman score: 2 for equal words, -1 for others and for gaps."""
    best, above = 0, [0] * (len(passage) + 1)
    for x in query:
        row = [0]
        for j, y in enumerate(passage):
            row.append(max(0, above[j] + (2 if x == y else -1), above[j + 1] - 1, row[j] - 1))
        best, above = max(best, max(row)), row
    return best


def leaks(texts, items, least=0.6):
    """Pairs with the share of the greatest score; only texts that share three words in a row.

    Items of over 40 words are found from the score on that 40 words need.
    """
    out = {}
    for k, text in texts:
        words = told_words(text)
        grams = {tuple(words[i : i + 3]) for i in range(len(words) - 2)}
        for i, item in items:
            query = told_words(item)
            if any(tuple(query[j : j + 3]) in grams for j in range(len(query) - 2)):
                score = align(query, words)
                if score >= 2 * least * min(len(query), 40) - 1e-9:
                    out[k, i] = score / (2 * len(query))
    return out


def bayes(labelled, texts, buckets=1 << 15):
    """``{key: (language, score)}`` by multinomial naive Bayes over hashed n-grams, one n-gram at a time."""
    full = (1 << 64) - 1

    def bucket(gram):
        key = len(gram)
        for c in gram:
            key = (key * 0x1F123BB5 + ord(c)) & full
        key = ((key ^ (key >> 30)) * 0xBF58476D1CE4E5B9) & full
        key = ((key ^ (key >> 27)) * 0x94D049BB133111EB) & full
        return (key ^ (key >> 31)) % buckets

    def grams(text):
        text = f" {text} ".lower()
        return Counter(text[i : i + n] for n in (1, 2, 3) for i in range(len(text) - n + 1))

    known, rows, seen = {}, Counter(), {}

    def at(gram):
        return known.setdefault(gram, bucket(gram)) if gram not in known else known[gram]

    for text, language in labelled:
        rows[language] += 1
        counts = seen.setdefault(language, Counter())
        for gram, n in grams(text).items():
            counts[at(gram)] += n
    total = {k: sum(c.values()) + 0.1 * buckets for k, c in seen.items()}
    out = {}
    for key, text in texts:
        if not any(c.isalpha() for c in text or ""):
            out[key] = ("und", 0.0)
            continue
        held = grams(text)
        logs = {
            k: math.log(rows[k] / sum(rows.values()))
            + sum(n * math.log((seen[k][at(g)] + 0.1) / total[k]) for g, n in held.items())
            for k in sorted(seen)
        }
        best = max(logs, key=logs.get)
        root = max(1.0, math.sqrt(sum(held.values())))
        out[key] = (best, 1 / sum(math.exp((v - logs[best]) / root) for v in logs.values()))
    return out


def held_out(key):
    return zlib.crc32(str(key).encode()) % 4 == 2


def centroid_rows(vectors, clusters=8, rounds=10):
    """Plain k-means over whole-number vectors, one Python integer at a time."""
    kept = [
        (k, [math.floor(1024 * float(x)) for x in v]) for k, v in vectors
        if v is not None and len(v) == 64 and all(x is not None and math.isfinite(x) for x in v)
    ]
    drawn = sorted(kept, key=lambda r: (sha(f"3:{'' if r[0] is None else r[0]}"), r[1]))
    centroids = [v for _, v in drawn[:clusters]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), i) for i, c in enumerate(centroids))

    for _ in range(rounds):
        own = [[] for _ in centroids]
        for _, v in kept:
            own[nearest(v)[1]].append(v)
        centroids = [
            [sum(x) // len(held) for x in zip(*held)] if held else c for held, c in zip(own, centroids)
        ]
    told = [(k, *nearest(v)) for k, v in kept]
    inertia = [sum(d for _, d, c in told if c == i) for i in range(len(centroids))]
    return sorted(
        ((k, c, d, inertia[c], sum(inertia), sha(",".join(map(str, centroids[c])))) for k, d, c in told), key=repr
    )


def merkle_rows(documents, fanout=8):
    """``doc_id, leaf, subroot, root, proof_sha256, folded_root, verified`` by lists and loops."""

    def field(value):
        return "-" if value is None else f"{len(str(value).encode())}:{value}"

    def leaf(row):
        return sha("".join(map(field, row)))

    def tree(nodes):
        """Root, and per node the (left, right) siblings of every level."""
        paths, spots, level = [[] for _ in nodes], list(range(len(nodes))), nodes
        while len(level) > 1:
            for path, at in zip(paths, spots):
                start = at - at % fanout
                path.append(("".join(level[start:at]), "".join(level[at + 1 : start + fanout])))
            level = [sha("".join(level[i : i + fanout])) for i in range(0, len(level), fanout)]
            spots = [at // fanout for at in spots]
        return level[0], paths

    small = {c: c + 32 for c in range(65, 91)}
    groups = {}
    for row in documents:
        doc_id, source, lang, n_chars, text = row
        tampered = doc_id is not None and zlib.crc32(str(doc_id).encode()) % 3 == 0
        claim = leaf((doc_id, source, lang, n_chars, text.translate(small) if text is not None and tampered else text))
        groups.setdefault(lang, []).append((doc_id is not None, doc_id, leaf(row), claim))
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {g: (sorted(groups[g], key=lambda r: (r[0], r[1] or 0, r[2]))) for g in order}
    roots = {g: tree([r[2] for r in trees[g]]) for g in order}
    if not order:
        return []
    root, tops = tree([roots[g][0] for g in order])
    rows = []
    for g, top in zip(order, tops):
        for (_, doc_id, own, claim), path in zip(trees[g], roots[g][1]):
            now = claim
            for left, right in path + top:
                now = sha(left + now + right)
            proof = sha("".join(a + b for a, b in path + top))
            rows.append((doc_id, own, roots[g][0], root, proof, now, now == root))
    return sorted(rows, key=repr)


def mix_targets(sizes, weights=(1, 2, 3), most=3):
    """Targets per source: shares by weight, cut at the most, the excess shared anew until none is above."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    target = dict.fromkeys(order, 0.0)
    left, free = float(sum(sizes.values())), list(order)
    while free and left > 1e-9:
        each = left / sum(weight[s] for s in free)
        for s in free:
            target[s] += each * weight[s]
        left = sum(max(0.0, target[s] - most * sizes[s]) for s in free)
        target = {s: min(t, float(most * sizes[s])) for s, t in target.items()}
        free = [s for s in free if target[s] < most * sizes[s]]
    return target
