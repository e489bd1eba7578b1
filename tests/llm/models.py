"""Brute-force versions of the corpus operators, on lists in memory."""

from __future__ import annotations

import hashlib
import re
from collections import Counter

import numpy as np
import xxhash

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
LAST = 1 << 62


def words(text):
    return WORDS.findall(text or "")


def sha(text):
    return hashlib.sha256(text.encode() if isinstance(text, str) else text).hexdigest()


def in_order(docs):
    """Rows by id (null last), then text."""
    return sorted(docs, key=lambda r: (r[0] is None, r[0] or 0, r[1] is not None, r[1] or ""))


def substring(docs, window=20):
    seen, out = set(), []
    for doc_id, text in in_order(docs):
        w = words(text)
        gone = [False] * len(w)
        for i in range(len(w) - window + 1):
            key = tuple(w[i:i + window])
            if key in seen:
                gone[i:i + window] = [True] * window
            seen.add(key)
        out.append((doc_id, len(w), sum(gone), sha(" ".join(x for x, g in zip(w, gone, strict=True) if not g))))
    return out


def suffix(docs, length=50):
    least = {}
    for doc_id, text in docs:
        b = (text or "").encode()
        for i in range(len(b) - length + 1):
            k = b[i:i + length]
            least[k] = min(least.get(k, LAST), LAST if doc_id is None else doc_id)
    out = []
    for doc_id, text in docs:
        b = (text or "").encode()
        gone = np.zeros(len(b), bool)
        for i in range(len(b) - length + 1):
            if least[b[i:i + length]] < (LAST if doc_id is None else doc_id):
                gone[i:i + length] = True
        spans = int((gone[1:] & ~gone[:-1]).sum() + gone[:1].sum())
        out.append((doc_id, len(b), int(gone.sum()), spans, sha(np.frombuffer(b, np.uint8)[~gone].tobytes())))
    return out


def exact(docs):
    """{(doc_id, text): (keep_id, group_size)} and the number of rows that stay."""
    norm = [re.sub(r"[\x20\x09-\x0D]+", " ", t or "") for _, t in docs]
    groups = {}
    for (d, _), n in zip(docs, norm, strict=True):
        groups.setdefault(n, []).append(d)
    out = []
    for (d, _), n in zip(docs, norm, strict=True):
        ids = [x for x in groups[n] if x is not None]
        out.append((d, min(ids) if ids else None, len(groups[n]), sha(n)))
    return out, len(groups)


def fingerprint(text, shingle=3):
    w = words(re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    if not w:
        return 0
    parts = [" ".join(w[i:i + shingle]) for i in range(len(w) - shingle + 1)] or [" ".join(w)]
    h = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def components(docs, distance=3):
    prints = [fingerprint(t) for _, t in docs]
    root = list(range(len(docs)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(docs)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= distance:
                root[find(i)] = find(j)
    out = []
    for i, (d, _) in enumerate(docs):
        ids = [docs[j][0] for j in range(len(docs)) if find(j) == find(i) and docs[j][0] is not None]
        out.append((d, f"{prints[i]:016x}", min(ids) if ids else None))
    return out, len({find(i) for i in range(len(docs))})


def base_counts(text):
    w = words(text)
    seen3 = Counter(zip(w, w[1:], w[2:]))  # noqa: B905
    cover = {i + k for i in range(len(w) - 2) for k in range(3) if seen3[tuple(w[i:i + 3])] > 1}
    seen, dups = set(), 0
    for line in (text or "").split("\n"):
        if words(line):
            dups += line in seen
            seen.add(line)
    return len(w), sum(map(len, w)), sum((text or "").count(c) for c in "#*$%&|<>"), dups, len(cover)


def mix_targets(sizes, weights=(3, 1, 2), share=1.5, epochs=2):
    """{source: target}, by handing round the excess again and again."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    full, total = set(), share * sum(sizes.values())
    while True:
        left = total - sum(epochs * sizes[s] for s in full)
        open_ = sum(weight[s] for s in order if s not in full)
        level = left / open_ if open_ else 0
        more = {s for s in order if s not in full and level * weight[s] > epochs * sizes[s]}
        if not more:
            return {s: epochs * sizes[s] if s in full else level * weight[s] for s in order}
        full |= more


LETTERS = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def divergence(docs, min_docs=10, top=10):
    """docs: (text, lang, source). Rows (lang, source, part, item, value, rank)."""
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    counts, seen = {}, {}
    for text, lang, source in docs:
        lang, source = lang or "", source or ""
        own = Counter(LETTERS.findall((text or "").translate(lower)))
        counts.setdefault(lang, {}).setdefault(source, Counter()).update(own)
        seen.setdefault(lang, Counter()).update(own.keys())
    out = []
    for lang, groups in counts.items():
        kept = [t for t, n in seen[lang].items() if n >= min_docs]

        def prices(c, kept=kept):
            total = sum(c[t] for t in kept)
            return {t: 1 + 1_000_000_000 * (c[t] + 2) // (total + 2 * len(kept)) for t in kept}

        whole = prices(sum(groups.values(), Counter()))
        own = {s: prices(c) for s, c in groups.items()}
        for s in groups:
            pairs = [(o, sum((own[s][t] - own[o][t]) ** 2 // (own[s][t] + own[o][t]) for t in kept)) for o in groups if o != s]
            terms = [(t, (own[s][t] - whole[t]) ** 2 // (own[s][t] + whole[t])) for t in kept if groups[s][t] and own[s][t] > whole[t]]
            for part, items, limit in (("pair", pairs, None), ("term", terms, top)):
                items.sort(key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, s, part, t, v, r) for r, (t, v) in enumerate(items[:limit], 1)]
    return out


UNIT = re.compile(r"[^\n]*\n|[^\n]+")


def fill_in_middle(docs, salt="7:", fim_rate=100, spm_rate=50):
    """docs: (doc_id, text). Rows (doc_id, n, form, prefix_chars, middle_chars, output, text)."""
    out = []
    for doc_id, text in docs:
        text = text or ""
        unit = UNIT.findall(text)
        digest = sha(salt + ("" if doc_id is None else str(doc_id)))
        h = [int(digest[8 * i:8 * i + 8], 16) for i in range(4)]
        a, b = sorted(x % (len(unit) + 1) for x in h[:2])
        p, m, s = "".join(unit[:a]), "".join(unit[a:b]), "".join(unit[b:])
        if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h[2] % 100 >= fim_rate:
            out.append((doc_id, len(unit), "plain", None, None, text, text))
        elif h[3] % 100 < spm_rate:
            out.append((doc_id, len(unit), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}", text))
        else:
            out.append((doc_id, len(unit), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}", text))
    return out


def convolve(model, text, chunk, step, width, stride):
    """A network's probability by plain loops over chunks, windows and filters."""
    data = list(text) + [256] * (chunk - len(text))
    at = [min(i, len(data) - chunk) for i in range(0, len(data) - chunk + step, step)] if len(text) > chunk else [0]
    pooled = []
    for s in at:
        best = []
        for f in range(model.filters.shape[1]):
            sums = []
            for w in range(s, s + chunk - width + 1, stride):
                sums.append(sum(float(model.embedding[data[w + k], e]) * float(model.filters[k * model.embedding.shape[1] + e, f])
                                for k in range(width) for e in range(model.embedding.shape[1])))
            best.append(max(0.0, max(sums) + float(model.filter_bias[f])))
        pooled.append(best)
    columns = list(zip(*pooled, strict=True))
    u = [max(c) for c in columns] + [sum(c) / len(c) for c in columns]
    h = [max(0.0, sum(x * float(w) for x, w in zip(u, model.hidden[:, j], strict=True)) + float(model.hidden_bias[j])) for j in range(model.hidden.shape[1])]
    z = sum(x * float(w) for x, w in zip(h, model.out, strict=True)) + float(model.out_bias[0])
    return 1 / (1 + np.exp(-z))
