"""Plain single-process versions of the operators, for small fixtures."""

import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def remove_repeats(rows, window=13):
    """[(doc_id, text)] -> [(doc_id, kept words, n_words, n_removed)]"""
    first = {}
    for doc, text in rows:
        w = words(text)
        for i in range(len(w) - window + 1):
            if doc is not None:
                k = tuple(w[i:i + window])
                first[k] = min(first.get(k, doc), doc)
    out = []
    for doc, text in rows:
        w = words(text)
        gone = set()
        for i in range(len(w) - window + 1):
            if doc is not None and first[tuple(w[i:i + window])] < doc:
                gone.update(range(i, i + window))
        out.append((doc, [x for i, x in enumerate(w) if i not in gone], len(w), len(gone)))
    return out


def shingles(text, n=5):
    w = words(lower(text))
    return frozenset(tuple(w[i:i + n]) for i in range(len(w) - n + 1)) if len(w) >= n else frozenset([tuple(w)] if w else [])


def join_components(rows):
    """[(doc_id, text)] -> {row number: (n_shingles, component)}; rows with one set are one."""
    sets = [shingles(t) if d is not None else frozenset() for d, t in rows]
    own = defaultdict(list)
    for i, s in enumerate(sets):
        if s:
            own[s].append(i)
    kinds = list(own)
    up = list(range(len(kinds)))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    at = defaultdict(list)
    for k, s in enumerate(kinds):
        for x in s:
            at[x].append(k)
    for k, s in enumerate(kinds):
        for j, c in Counter(j for x in s for j in at[x] if j < k).items():
            if 100 * c >= 80 * (len(s) + len(kinds[j]) - c):
                up[find(k)] = find(j)
    least = {}
    for k, s in enumerate(kinds):
        low = min(rows[i][0] for i in own[s])
        least[find(k)] = min(least.get(find(k), low), low)
    return [(len(shingles(t)), least[find(kinds.index(sets[i]))] if sets[i] else d) for i, (d, t) in enumerate(rows)]


def drop_lines(rows, depth=3, min_docs=10, min_share=0.1, min_constant=0.5):
    """[(doc_id, text)] -> [(kept text, n_lines, n_dropped)]"""
    mask = lambda w: "<*>" if re.search(r"[0-9@]|://", w) else w
    found = []
    for r, (doc, text) in enumerate(rows):
        for i, line in enumerate((text or "").split("\n")):
            t = tuple(map(mask, words(line)))
            if t and doc is not None:
                found.append((r, i, (len(t), t[:depth]), t))
    leaves = Counter(f[2] for f in found)
    found = [f for f in found if leaves[f[2]] >= min_docs]
    distinct = defaultdict(set)
    for _, _, leaf, t in found:
        distinct[leaf].add(t)
    support = Counter((leaf, i, x) for leaf, ts in distinct.items() for t in ts for i, x in enumerate(t))
    shaped, alike_in = {}, Counter()
    for leaf, ts in distinct.items():
        for t in ts if len(ts) > 1 else ():
            own = [support[leaf, i, x] if x != "<*>" and support[leaf, i, x] >= 2 else None for i, x in enumerate(t)]
            leading, beyond = sum(x is not None for x in own[:depth]), sorted((x for x in own[depth:] if x is not None), reverse=True)
            needed = max(1, math.ceil(len(t) * min_constant) - leading)
            if needed <= len(beyond):
                alike = beyond[needed - 1]
                shape = tuple(x if n is not None and (i < depth or n >= alike * min_share) else "<*>" for i, (x, n) in enumerate(zip(t, own)))
                shaped[leaf, t] = shape
                alike_in[leaf, shape, alike] += 1
    chance = {(leaf, shape) for (leaf, shape, alike), n in alike_in.items() if n < alike * min_share}
    template = {}
    for leaf, ts in distinct.items():
        for t in ts:
            general = (leaf, t) in shaped and (leaf, shaped[leaf, t]) not in chance
            template[leaf, t] = (leaf, general, shaped[leaf, t] if general else t)
    docs = defaultdict(set)
    for r, _, leaf, t in found:
        docs[template[leaf, t]].add(rows[r][0])
    gone = defaultdict(set)
    for r, i, leaf, t in found:
        d = docs[template[leaf, t]]
        if len(d) >= min_docs and rows[r][0] != min(d):
            gone[r].add(i)
    return [("\n".join(x for i, x in enumerate((t or "").split("\n")) if i not in gone[r]), len((t or "").split("\n")), len(gone[r])) for r, (_, t) in enumerate(rows)]


def base_counts(text):
    w = words(text)
    tri = Counter(tuple(w[i:i + 3]) for i in range(len(w) - 2))
    covered = {j for i in range(len(w) - 2) if tri[tuple(w[i:i + 3])] > 1 for j in range(i, i + 3)}
    lines = Counter(x for x in (text or "").split("\n") if words(x))
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), sum(lines.values()) - len(lines), len(covered))


def base_failed(text):
    n, _, _, _, repeat = base_counts(text)
    return n < 50 or 100 * repeat > 50 * n


def _classes(text):
    out = [0] * 10
    for c in text or "":
        o = ord(c)
        out[0 if "a" <= c <= "z" else 1 if "A" <= c <= "Z" else 2 if "0" <= c <= "9" else 3 if c in " \t\n\x0b\x0c\r" else 4 if c in ".,"
            else 5 if c in ";:!?'\"()-" else 6 if o < 128 else 7 if o < 0x800 else 8 if o < 0x10000 else 9] += 1
    return out


def _jensen_shannon(a, b):
    sa, sb, total = sum(a) or 1, sum(b) or 1, 0.0
    for x, y in zip(a, b):
        p, q = x / sa, y / sb
        m = (p + q) / 2
        total += (p * math.log2(p / m) if p else 0) + (q * math.log2(q / m) if q else 0)
    return math.sqrt(max(total / 2, 0))


def quality_kept(rows, common, rules):
    """[(text, lang)] -> kept flags"""
    def hist(text, ws):
        w = [lower(x) for x in words(text)]
        c = Counter(w)
        own = [c[x] for x in sorted(ws)]
        return own + [len(w) - sum(own)]

    of_lang = Counter(lang for _, lang in rows if lang is not None)
    common = {lang: set(ws.split()) for lang, ws in common.items()}
    for lang, n in of_lang.items():
        if lang not in common and n >= rules.min_docs:
            seen = Counter(lower(w) for t, x in rows if x == lang and not base_failed(t) for w in words(t))
            if seen:
                common[lang] = {w for w, _ in sorted(seen.items(), key=lambda x: (-x[1], x[0].encode()))[:rules.common_words]}
    sums = {}
    for text, lang in rows:
        if lang in common and not base_failed(text):
            h = _classes(text) + hist(text, common[lang])
            sums[lang] = [x + y for x, y in zip(sums.get(lang, [0] * len(h)), h)]
    out = []
    for text, own_lang in rows:
        chars, n = _classes(text), len(words(text))
        fine = not sums or (own_lang is not None and own_lang not in sums)
        for lang, s in sums.items():
            h = hist(text, common[lang])
            fine |= ((sum(chars) < rules.min_chars or _jensen_shannon(chars, s[:10]) <= rules.chars_distance)
                     and (n < rules.min_hist_words or _jensen_shannon(h, s[10:]) <= rules.words_distance))
        out.append(not base_failed(text) and fine)
    return out


def best_products(vectors, every=50, k=5):
    """[(id, vector or None)] -> {(query, rank, id, score)}"""
    good = [(i, np.floor(256 * np.array(v, float)).astype(int)) for i, v in vectors
            if i is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    out = set()
    for q, x in {(i, tuple(v)) for i, v in good if i % every == 0}:
        s = sorted((-int(np.dot(x, y)), i) for i, y in good if i != q and len(y) == len(x))[:k]
        out |= {(q, r + 1, i, -v) for r, (v, i) in enumerate(s)}
    return out


def check_packing(pieces, rows, encode, length=2048):
    """Pieces cover every document's ids exactly, sequences are gapless; returns the share of padding."""
    own = defaultdict(list)
    for p in pieces:
        own[p["doc_id"]].append(p)
    want = defaultdict(Counter)
    for doc, text in rows:
        want[doc][tuple([*encode(text or ""), 1])] += 1
    for doc, texts in want.items():
        have = Counter((p["start"], p["length"], p["ids_crc32"], p["doc_tokens"]) for p in own.pop(doc))
        if sum(texts.values()) == 1:
            ids, at = np.array(next(iter(texts)), "<u4"), 0
            for start, n, crc, total in sorted(have):
                assert (start, total) == (at, len(ids)) and zlib.crc32(ids[at:at + n].tobytes()) == crc
                at += n
            assert at == len(ids)
        else:
            assert sum(n * c for (_, n, _, _), c in have.items()) == sum(len(t) * c for t, c in texts.items())
    assert not own
    sequences = defaultdict(list)
    for p in pieces:
        sequences[p["sequence_id"]].append((p["offset"], p["length"]))
    pad = total = 0
    for ps in sequences.values():
        at = 0
        for offset, n in sorted(ps):
            assert offset == at
            at += n
        assert at <= length
        total += at
        pad += 0 if at & (at - 1) == 0 else length - at
    return pad / max(1, total)
