"""Plain versions of the operators, for small inputs."""

import re
from collections import Counter

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


def shingles(text, n=5):
    w = words(re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else ({tuple(w)} if w else set())


def components(ids, linked):
    low = {i: i for i in ids}

    def find(i):
        while low[i] != i:
            i = low[i]
        return i

    ids = sorted(ids)
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            if linked(a, b):
                x, y = sorted((find(a), find(b)))
                low[y] = x
    return {i: find(i) for i in ids}


def jaccard_components(docs):
    sets = {d: shingles(t) for d, t in docs.items()}

    def linked(a, b):
        both, union = len(sets[a] & sets[b]), len(sets[a] | sets[b])
        return bool(sets[a]) and bool(sets[b]) and 100 * both >= 80 * union

    return {d: len(s) for d, s in sets.items()}, components(docs, linked)


def repeats(docs, width=50):
    first, split = {}, {d: words(t) for d, t in docs.items()}
    for d in sorted(split):
        w = split[d]
        for i in range(len(w) - width + 1):
            first.setdefault(tuple(w[i : i + width]), d)
    out = {}
    for d, w in split.items():
        gone = [False] * len(w)
        for i in range(len(w) - width + 1):
            if first[tuple(w[i : i + width])] < d:
                gone[i : i + width] = [True] * width
        out[d] = (len(w), sum(gone), " ".join(x for x, g in zip(w, gone) if not g))
    return out


def line_runs(docs, least=2, long=20):
    """Runs of ``least`` lines with a word, and lines of ``long`` words, that start earlier too."""
    seen, out = {}, {}
    split = {d: (t or "").split("\n") for d, t in docs.items()}
    real = {d: [i for i, line in enumerate(lines) if WORD.search(line)] for d, lines in split.items()}
    places = [(d, i, least) for d in sorted(docs) for i in range(len(real[d]) - least + 1)]
    places += [(d, i, 1) for d in sorted(docs) for i, k in enumerate(real[d]) if least > 1 and len(words(split[d][k])) >= long]
    run = lambda d, i, size: tuple(split[d][k] for k in real[d][i : i + size])
    for p in places:
        seen.setdefault(run(*p), p)
    gone = {d: set() for d in docs}
    for d, i, size in places:
        if seen[run(d, i, size)] != (d, i, size):
            gone[d].update(real[d][i : i + size])
    for d, lines in split.items():
        out[d] = (len(real[d]), len(gone[d]), "\n".join(x for i, x in enumerate(lines) if i not in gone[d]))
    return out


def base_quality(text):
    w = words(text)
    grams = list(zip(w, w[1:], w[2:]))
    count, cover = Counter(grams), [False] * len(w)
    for i, g in enumerate(grams):
        if count[g] > 1:
            cover[i : i + 3] = [True] * 3
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), dup, sum(cover), len(w) < 50 or 100 * sum(cover) > 50 * len(w)


def ngram_counts(text):
    """Runs of letters, lower-cased and padded with a blank on either side: n-grams of one to three characters."""
    out = Counter()
    for run in re.findall(r"[^\W\d_]+", (text or "").lower()):
        padded = f" {run} "
        for n in (1, 2, 3):
            out.update(g for g in (padded[i : i + n] for i in range(len(padded) - n + 1)) if g != " ")
    return out


def profile(counts, ranks=400):
    return sorted(counts, key=lambda g: (-counts[g], len(g), g))[:ranks]


def language(text, profiles, ranks=400):
    """The nearest profile by out-of-place distance (ties by name) and 1 less the share of the largest distance."""
    own = profile(ngram_counts(text), ranks)
    if not own or not profiles:
        return "und", 0.0
    away = {}
    for lang in sorted(profiles):
        place = {g: i for i, g in enumerate(profiles[lang])}
        away[lang] = sum(abs(place[g] - i) if g in place else ranks for i, g in enumerate(own))
    best = min(away, key=lambda x: (away[x], x))
    return best, 1.0 - away[best] / (ranks * len(own))


def url_verdict(url, rules, default="allow"):
    """host, path, rule and verdict by trying every rule (host, path, verdict)."""
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.match("[^/?#]*", rest).group()
        path = re.match("[^?#]*", rest[len(host) :]).group()
        host = re.sub("[A-Z]", lambda m: m.group().lower(), host)
    fits = [(len(h + p), len(h), v == "block", v, h + p) for h, p, v in rules if h and p is not None and v and host and (host == h or host.endswith("." + h)) and path.startswith(p)]
    return (host, path, max(fits)[4], max(fits)[3]) if fits else (host, path, None, default)


def collocations(docs, max_n=5, min_count=100, top=2000, keep_below=100):
    """(lang, rank, phrase, a, l, r, n, score) of ``docs`` (lang, text)."""
    counts, totals = Counter(), Counter()
    for lang, text in docs:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\n-\r]", re.sub("[A-Z]", lambda m: m.group().lower(), text or "")):
            w = tuple(re.findall("[^ \t]+", piece))
            totals[lang] += len(w)
            for k in range(1, max_n + 1):
                counts.update((lang, w[i : i + k]) for i in range(len(w) - k + 1))
    found = {key: a for key, a in counts.items() if len(key[1]) > 1 and a >= min_count}
    inside = lambda p, q: len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q)))
    rows = {}
    for (lang, p), a in found.items():
        if any(m == lang and inside(p, q) and 100 * b >= keep_below * a for (m, q), b in found.items()):
            continue
        cuts = [(1000 * a * totals[lang] // (counts[lang, p[:k]] * counts[lang, p[k:]]), k, counts[lang, p[:k]], counts[lang, p[k:]]) for k in range(1, len(p))]
        score, _, left, right = min(cuts)
        rows.setdefault(lang, []).append((-score, -a, " ".join(p).encode(), left, right))
    return sorted((lang, i, p.decode(), -a, x, y, totals[lang], -s) for lang, each in rows.items() for i, (s, a, p, x, y) in enumerate(sorted(each)[:top], 1))


def lloyd(vectors, k=8, dim=64, rounds=10):
    """vec_id -> (cluster, distance) and the centroids, for distinct ids."""
    import hashlib
    import math

    ok = {i: [math.floor(1024 * float(x)) for x in v] for i, v in vectors if v is not None and len(v) == dim and all(x is not None and math.isfinite(x) for x in v)}
    cents = [ok[i] for i in sorted((i for i in ok if i is not None), key=lambda i: hashlib.sha256(f"3:{i}".encode()).hexdigest())[:k]]
    near = lambda v: min((sum((a - b) ** 2 for a, b in zip(v, c)), j) for j, c in enumerate(cents))
    for _ in range(rounds):
        own = {}
        for i, v in ok.items():
            own.setdefault(near(v)[1], []).append(v)
        cents = [[sum(x) // len(own[j]) for x in zip(*own[j])] if j in own else c for j, c in enumerate(cents)]
    return {i: near(v)[::-1] for i, v in ok.items()}, cents


def _bare(word, ends=".,;:!?()[]\"'"):
    return word.strip(ends)


def _luhn(digits):
    doubled = [int(d) * 2 if i % 2 else int(d) for i, d in enumerate(digits[::-1])]
    return sum(d // 10 + d % 10 for d in doubled) % 10 == 0


def _iban(text):
    moved = text[4:] + text[:4]
    return int("".join(c if c.isdigit() else str(ord(c) - 55) for c in moved)) % 97 == 1


def personal(text):
    """(kind, normal form) of what a reader finds word by word: addresses, social security numbers, cards, IBANs and names behind Mrs, Mr, Frau, Herr, Mme."""
    found, tokens = set(), (text or "").split()
    for i, token in enumerate(tokens):
        word = _bare(token)
        local, _, domain = word.partition("@")
        if local and "." in domain and domain.rsplit(".", 1)[1].isalpha() and local[0].isalnum():
            found.add(("email", word.lower()))
        parts = word.split(".")
        if len(parts) == 4 and all(p.isdigit() and int(p) < 256 for p in parts):
            found.add(("ip", ".".join(str(int(p)) for p in parts)))
        dashed = word.split("-")
        if [len(p) for p in dashed] == [3, 2, 4] and "".join(dashed).isdigit():
            found.add(("ssn", "".join(dashed)))
        if len(word) == 16 and word.isdigit() and _luhn(word):
            found.add(("card", word))
        four = [_bare(t) for t in tokens[i : i + 4]]
        if [len(p) for p in four] == [4] * 4 and "".join(four).isdigit() and _luhn("".join(four)):
            found.add(("card", "".join(four)))
        if [len(p) for p in dashed] == [4] * 4 and "".join(dashed).isdigit() and _luhn("".join(dashed)):
            found.add(("card", "".join(dashed)))
        if word[:2].isupper() and word[:2].isalpha() and word[2:4].isdigit():
            for j in range(i + 1, min(i + 10, len(tokens)) + 1):
                joined = "".join(_bare(t) for t in tokens[i:j])
                if 15 <= len(joined) <= 34 and joined.isalnum() and joined.isupper() and _iban(joined):
                    found.add(("iban", joined))
        if word in ("Mrs", "Mr", "Frau", "Herr", "Mme") and token.rstrip(".").endswith(word):
            names = []
            for t in tokens[i + 1 : i + 4]:
                if not t[0].isupper() or not _bare(t).isalpha():
                    break
                names.append(_bare(t))
                if t != _bare(t):
                    break
            if names:
                found.add(("name", " ".join(names).lower()))
    return found
