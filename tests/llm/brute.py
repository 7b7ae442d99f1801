"""Plain Python versions of the text operators' contracts, for small inputs.

``docs`` is a list of (doc_id, text) with integer ids unless a test says otherwise.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import xxhash

SPACES = "[\x20\x09-\x0d]+"


def words(text):
    return [w for w in re.split(SPACES, text or "") if w]


def sha(data):
    return hashlib.sha256(data if isinstance(data, bytes) else data.encode()).hexdigest()


def lower(text):
    return re.sub("[A-Z]", lambda m: chr(ord(m[0]) + 32), text or "")


def simhash(text, shingle=3):
    found = words(lower(text))
    if not found:
        return 0
    count = max(1, len(found) - shingle + 1)
    hashes = [xxhash.xxh64_intdigest(" ".join(found[i : i + shingle]).encode(), 42) for i in range(count)]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > count)


def components(prints, distance=2):
    """Smallest id reachable for {id: print}."""
    root = {i: i for i in prints}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(prints)
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            if (prints[a] ^ prints[b]).bit_count() <= distance:
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {i: find(i) for i in ids}


def exact(docs):
    groups = defaultdict(list)
    for doc_id, text in docs:
        groups[re.sub(SPACES, "", text or "")].append((-len(text or ""), doc_id))
    out = []
    for doc_id, text in docs:
        norm = re.sub(SPACES, "", text or "")
        keep = min(groups[norm])[1]
        out.append((doc_id, keep, len(groups[norm]), doc_id == keep, sha(norm)))
    return out


def substrings(docs, window=50):
    first = {}
    for doc_id, text in docs:
        found = words(text)
        for i in range(len(found) - window + 1):
            key = tuple(found[i : i + window])
            first[key] = min(first.get(key, doc_id), doc_id)
    out = []
    for doc_id, text in docs:
        found = words(text)
        gone = [False] * len(found)
        for i in range(len(found) - window + 1):
            if first[tuple(found[i : i + window])] < doc_id:
                gone[i : i + window] = [True] * window
        kept = [w for w, g in zip(found, gone, strict=True) if not g]
        out.append((doc_id, len(found), sum(gone), sha(" ".join(kept))))
    return out


def edited(docs):
    """{id: edited text} with the next document in descending id order."""
    order = sorted(docs, key=lambda d: -d[0])
    out = {}
    for i, (doc_id, text) in enumerate(order):
        text, after = text or "", order[(i + 1) % len(order)][1] or ""
        third = len(text) // 3
        out[doc_id] = (text[: len(text) - third] + after[:third], order[(i + 1) % len(order)][0])
    return out


def spot_set(text, common, chain=2):
    found = [w for w in re.split(r"[\W_]+", (text or "").lower()) if w]
    out = set()
    for i, w in enumerate(found):
        if w in common:
            after = [x for x in found[i + 1 :] if x not in common][:chain]
            if len(after) == chain:
                out.add((w, *after))
    return out or ({("all", *[w for w in found if w not in common], sum(w in common for w in found))} if found else set())


def likeness(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def crc(data):
    return zlib.crc32(data if isinstance(data, bytes) else data.encode())


def url_parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    return lower(host), re.match(r"[^?#]*", rest[len(host) :])[0]


def url_rule(url, rules):
    host, path = url_parts(url)
    fits = [
        (len(h.split(".")), len(p), v == "block", h + p, v)
        for v, h, p in rules
        if host and (host == h or host.endswith("." + h)) and path.startswith(p)
    ]
    return (max(fits)[3:] if fits else (None, "allow")), host, path


def duplicates(values):
    return [v for v, n in Counter(values).items() if n > 1]
