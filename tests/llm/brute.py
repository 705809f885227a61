"""Plain Python versions of what the operators must return."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import xxhash

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
ASSIGN = re.compile(
    r"([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])"
    r"[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)
ACCESS, HEX = re.compile(r"AKIA[A-Z0-9]+"), re.compile(r"[0-9a-f]+")


def digits(s):
    return [int(c) for c in s if c in "0123456789"]


def luhn(s):
    return sum(d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d) for i, d in enumerate(digits(s)[::-1])) % 10 == 0


def pii(text):
    text = text or ""
    out = {"email": [m.span() for m in EMAIL.finditer(text)]}
    out["ip"] = [m.span() for m in IP.finditer(text) if all(int(p) <= 255 for p in m[0].split("."))]
    out["card"] = [m.span() for m in CARD.finditer(text) if 13 <= len(digits(m[0])) <= 19 and luhn(m[0])]
    out["phone"] = [m.span() for m in PHONE.finditer(text) if 9 <= len(digits(m[0])) <= 15]
    return out


def pii_sha(found):
    names = [f"{k}:{a}:{b}" for k in ("email", "ip", "card", "phone") for a, b in found[k]]
    return hashlib.sha256(",".join(names).encode()).hexdigest()


def secrets(text):
    text = text or ""
    out = {"assign": [m.span() for m in ASSIGN.finditer(text) if len(m[2]) >= 6]}
    out["access"] = [m.span() for m in ACCESS.finditer(text) if len(m[0]) >= 20]
    out["hex"] = [m.span() for m in HEX.finditer(text) if len(m[0]) >= 24]
    return out


def secrets_sha(found):
    kinds = ("assign", "access", "hex")
    rows = sorted((a, kinds.index(k), b) for k in kinds for a, b in found[k])
    return hashlib.sha256(",".join(f"{kinds[k]}:{a}:{b}" for a, k, b in rows).encode()).hexdigest()


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def quality(text):
    text = text or ""
    w = words(text)
    windows = defaultdict(list)
    for i in range(len(w) - 4):
        windows[tuple(w[i : i + 5])].append(i)
    repeated = {j for at in windows.values() if len(at) > 1 for i in at for j in range(i, i + 5)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if words(line):
            dup += line in seen
            seen.add(line)
    n = len(w)
    return n, sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), dup, len(repeated), n < 10 or 100 * len(repeated) > 20 * n


def fingerprint(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    w = words(lower)
    if not w:
        return 0
    shingles = [" ".join(w[i : i + 3]) for i in range(len(w) - 2)] or [" ".join(w)]
    counts = Counter()
    for s in shingles:
        h = xxhash.xxh64_intdigest(s.encode(), seed=42)
        counts.update(b for b in range(64) if h >> b & 1)
    return sum(1 << b for b in range(64) if 2 * counts[b] > len(shingles))


def components(nodes, edges):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def simhash_groups(rows):
    """{doc_id: (fingerprint, component)} of (doc_id, text)."""
    fps = {d: fingerprint(t) for d, t in rows}
    ids, values = list(fps), np.array(list(fps.values()), np.uint64)
    edges = []
    for i, a in enumerate(ids):
        near = np.bitwise_count(values[:i] ^ values[i]) <= 2
        edges += [(ids[j], a) for j in np.flatnonzero(near)]
    roots = components(sorted(ids), edges)
    return {d: (f"{fps[d]:016x}", roots[d]) for d in ids}


def embedding_groups(rows, threshold=0.93):
    """{vec_id: (links, component)} of (vec_id, vector, label)."""
    good = [(i, np.array(v, float), x) for i, v, x in rows if x is not None and v and all(c is not None and math.isfinite(c) for c in v) and any(v)]
    links, edges = Counter(), []
    for k, (i, v, x) in enumerate(good):
        for j, u, y in good[:k]:
            if x == y and len(u) == len(v) and u @ v / (np.linalg.norm(u) * np.linalg.norm(v)) >= threshold:
                links[i] += 1
                links[j] += 1
                edges.append((i, j))
    roots = components(sorted(r[0] for r in rows), edges)
    return {r[0]: (links[r[0]], roots[r[0]]) for r in rows}


RULES = [("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"), ("allow", "com", "/fr/"), ("block", "com", "/de/")]


def url(u):
    """host, path, rule, verdict of the rule."""
    if u is None or "://" not in u:
        return "", "", None, None
    rest = u.split("://", 1)[1]
    host = re.split(r"[/?#]", rest)[0]
    path = re.split(r"[?#]", rest[len(host) :])[0]
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fit = [(len(h + p), h + p, v) for v, h, p in RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fit, default=(0, None, None))
    return host, path, best[1], best[2]


def crc(doc_id):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode())


def targets(sizes):
    """{source: target} of {source: words}: shares by weight, those above twice the size stopped, the excess shared anew."""
    order = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    left, target, open_ = 1.5 * sum(sizes.values()), {}, list(order)
    while open_:
        level = left / sum(weight[s] for s in open_)
        over = [s for s in open_ if level * weight[s] > 2 * sizes[s]]
        if not over:
            target.update({s: level * weight[s] for s in open_})
            break
        for s in over:
            target[s] = 2.0 * sizes[s]
            left -= target[s]
        open_ = [s for s in open_ if s not in over]
    return target


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def _tree(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        n = levels[-1]
        levels.append([sha("".join(n[i : i + 16])) for i in range(0, len(n), 16)])
    return levels


def _path(levels, i):
    out = []
    for level in levels[:-1]:
        a = i // 16 * 16
        out.append(("".join(level[a:i]), "".join(level[i + 1 : a + 16])))
        i //= 16
    return out


def merkle(docs):
    """What each row of (doc_id, source, lang, n_chars, text) gets, sorted."""

    def leaf(d, text):
        return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (d.doc_id, d.source, d.lang, d.n_chars, text)))

    by_source = defaultdict(list)
    for d in docs:
        by_source[d.source].append(d)
    for rows in by_source.values():
        rows.sort(key=lambda d: (d.doc_id is not None, d.doc_id or 0, leaf(d, d.text)))
    trees = {s: _tree([leaf(d, d.text) for d in rows]) for s, rows in by_source.items()}
    names = sorted(trees, key=lambda s: (s is not None, (s or "").encode()))
    top = _tree([trees[s][-1][0] for s in names])
    out = []
    for k, s in enumerate(names):
        for i, d in enumerate(by_source[s]):
            path = _path(trees[s], i) + _path(top, k)
            text = d.text
            if text and d.doc_id is not None and crc(d.doc_id) % 5 == 0:
                text = text.translate({c: c + 32 for c in range(65, 91)})
            at = leaf(d, text)
            for before, after in path:
                at = sha(before + at + after)
            root = top[-1][0]
            out.append((d.doc_id, trees[s][0][i], trees[s][-1][0], root, sha("".join(b + a for b, a in path)), at, at == root))
    return sorted(out, key=str)


def trie(turns):
    """Nodes of (conv_id, turn, role, text), sorted."""
    convs = defaultdict(list)
    for c, turn, role, text in turns:
        if c is not None:
            convs[c].append((turn is not None, turn or 0, role or "", text or ""))
    built = {}
    for c, own in convs.items():
        h = crc(c) % 9
        base = sorted(convs.get(c - int(math.fmod(c, 5)), []))
        built[c] = tuple(t[2:] for t in base[:h] + sorted(own)[h:])
    members, kids = defaultdict(list), defaultdict(list)
    for c, path in built.items():
        for d in range(len(path) + 1):
            members[path[:d]].append(c)
    for path in members:
        if path:
            kids[path[:-1]].append(path)
    leaves, saves, out = {}, {}, []
    for path in sorted(members, key=len, reverse=True):
        m = members[path]
        leaves[path] = sum(leaves[k] for k in kids[path]) or 1
        saves[path] = sum(saves[k] for k in kids[path]) + ((len(m) - 1) * len(path[-1][1].encode()) if path else 0)
        ends = sha(",".join(str(c) for c in sorted(m) if len(built[c]) == len(path)))
        out.append((min(m), len(path), min(members[path[:-1]]) if path else None, len(m), len(kids[path]), leaves[path], saves[path], ends))
    return sorted(out, key=str)


def unigram(docs):
    """Per row: held_out, n_tokens, n_known, train_tokens, base_score."""
    texts = [(crc("" if d.doc_id is None else d.doc_id) % 7 == 2, (d.text or "").translate({c: c + 32 for c in range(65, 91)})) for d in docs]
    texts = [(h, [*words(t), None]) for h, t in texts]
    counts = Counter(w for h, t in texts if not h for w in t)
    n, v = sum(counts.values()), len(counts)
    return [(h, len(t), sum(counts[w] > 0 for w in t), n, sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in t)) for h, t in texts]
