"""Plain-Python versions of the operators, for tests on small inputs."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")
AZ = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def sha(b):
    return hashlib.sha256(b if isinstance(b, bytes) else b.encode()).hexdigest()


def crc(doc_id):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode())


def repeats(docs, length=50):
    """(doc_id, text) rows -> (doc_id, n_bytes, n_removed, n_spans, kept_sha256)."""
    first = {}
    raw = [(d, (t or "").encode()) for d, t in docs]
    big = 1 << 63
    for d, b in raw:
        for i in range(len(b) - length + 1):
            w = b[i:i + length]
            first[w] = min(first.get(w, big), big if d is None else d)
    out = []
    for d, b in raw:
        gone = bytearray(len(b))
        for i in range(len(b) - length + 1):
            if first[b[i:i + length]] < (big if d is None else d):
                gone[i:i + length] = b"\1" * length
        runs = sum(1 for i in range(len(b)) if gone[i] and (i == 0 or not gone[i - 1]))
        out.append((d, len(b), sum(gone), runs, sha(bytes(x for x, g in zip(b, gone) if not g))))
    return out


def shingles(text):
    w = WORD.findall((text or "").translate(AZ))
    if not w:
        return frozenset()
    return frozenset([tuple(w)] if len(w) < 5 else [tuple(w[i:i + 5]) for i in range(len(w) - 4)])


def near(docs):
    """(doc_id, text) rows -> (doc_id, n_shingles, component_id)."""
    sets = [shingles(t) for _, t in docs]
    post = defaultdict(list)
    for i, s in enumerate(sets):
        for x in s:
            post[x].append(i)
    up = list(range(len(docs)))

    def root(i):
        while up[i] != i:
            up[i] = up[up[i]]
            i = up[i]
        return i

    for i, s in enumerate(sets):
        common = Counter(j for x in s for j in post[x] if j < i)
        for j, k in common.items():
            if 100 * k >= 75 * (len(s) + len(sets[j]) - k):
                up[root(i)] = root(j)
    ids = defaultdict(list)
    for i, (d, _) in enumerate(docs):
        ids[root(i)].append(d)
    least = {r: min((x for x in v if x is not None), default=None) for r, v in ids.items()}
    return [(d, len(s), least[root(i)]) for i, ((d, _), s) in enumerate(zip(docs, sets))]


KINDS = (("assign", re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A), 2, 12),
         ("access", re.compile(r"AKIA[A-Z0-9]+"), 0, 18), ("hex", re.compile(r"[0-9a-f]+"), 0, 16))


def base_spans(text):
    found = [(m.start(), k, m.end()) for k, (_, p, g, n) in enumerate(KINDS)
             for m in p.finditer(text or "") if len(m.group(g)) >= n]
    return sorted(found)


def spans_text(spans):
    return ",".join(f"{KINDS[k][0]}:{a}:{b}" for a, k, b in spans)


def quality(text):
    text = text or ""
    w = WORD.findall(text)
    tri = Counter(tuple(w[i:i + 3]) for i in range(len(w) - 2))
    hit = set()
    for i in range(len(w) - 2):
        if tri[tuple(w[i:i + 3])] > 1:
            hit |= {i, i + 1, i + 2}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(hit),
            len(w) < 50 or 100 * len(hit) > 50 * len(w))


def unigram_scores(docs):
    """(doc_id, text) rows -> (doc_id, held_out, n_tokens, n_known, train_tokens, base_score)."""
    toks = [[*WORD.findall((t or "").translate(AZ)), None] for _, t in docs]
    c = Counter(x for (d, _), t in zip(docs, toks) if crc(d) % 10 for x in t)
    n, v = sum(c.values()), len(c)
    z = math.log10(n + 0.1 * (v + 1))
    return [(d, crc(d) % 10 == 0, len(t), sum(c[x] > 0 for x in t), n, sum(math.log10(c[x] + 0.1) - z for x in t))
            for (d, _), t in zip(docs, toks)]


def url_parts(url):
    if not url or "://" not in url:
        return "", ""
    rest = re.split(r"[?#]", url.split("://", 1)[1], maxsplit=1)[0]
    host, slash, path = rest.partition("/")
    return host.translate(AZ), slash + path


def url_rule(url, rules):
    host, path = url_parts(url)
    best = None
    for verdict, rule in rules:
        name, _, tail = rule.partition("/")
        if (host == name or host.endswith("." + name)) and path.startswith("/" + tail):
            if best is None or len(rule) > len(best[1]):
                best = (verdict, rule)
    return best
