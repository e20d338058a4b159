"""Plain single-process versions of the operators, for small tables."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def byte_ids(tokenizer, text):
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]


def crc(ids):
    return zlib.crc32(b"".join(i.to_bytes(4, "little") for i in ids))


def repeats(docs, window=35):
    """doc_id, n_words, n_removed, sha256 of what is kept, for (doc_id, text) rows."""
    words = [WORD.findall(t or "") for _, t in docs]
    seen = Counter(tuple(w[i : i + window]) for w in words for i in range(len(w) - window + 1))
    out = []
    for (doc_id, _), w in zip(docs, words):
        gone = set()
        for i in range(len(w) - window + 1):
            if seen[tuple(w[i : i + window])] > 1:
                gone.update(range(i, i + window))
        kept = [x for i, x in enumerate(w) if i not in gone]
        out.append((doc_id, len(w), len(gone), hashlib.sha256(" ".join(kept).encode()).hexdigest()))
    return out


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def shingles(text, size):
    w = WORD.findall(lower(text or ""))
    return {tuple(w[i : i + size]) for i in range(len(w) - size + 1)} if len(w) >= size else ({tuple(w)} if w else set())


def roots(nodes, links):
    parent = {n: n for n in nodes}

    def find(n):
        while parent[n] != n:
            parent[n] = parent[parent[n]]
            n = parent[n]
        return n

    for a, b in links:
        a, b = sorted((find(a), find(b)))
        parent[b] = a
    return {n: find(n) for n in nodes}


def near(docs, size=2, percent=80):
    sets = {d: shingles(t, size) for d, t in docs}
    by = defaultdict(set)
    for d, s in sets.items():
        for x in s:
            by[x].add(d)
    links = []
    for a, s in sets.items():
        common = Counter(b for x in s for b in by[x] if b > a)
        links += [(a, b) for b, n in common.items() if 100 * n >= percent * (len(s) + len(sets[b]) - n)]
    root = roots(sets, links)
    return [(d, len(s), root[d], root[d] == d) for d, s in sets.items()]


def article(page, levels=8):
    """Main text of a well-formed page of div, section, article, ul, li, p, a and nav, scored element by element from the definition."""
    from html.parser import HTMLParser

    class Node:
        def __init__(self, tag, up):
            self.tag, self.up, self.inside = tag, up, []

        def above(self):
            return [] if self.up is None else [self.up, *self.up.above()]

    class Tree(HTMLParser):
        def __init__(self):
            super().__init__()
            self.root = self.at = Node("", None)
            self.all, self.blocks, self.parts = [self.root], [], []

        def end_block(self):
            text = " ".join("".join(t for t, _ in self.parts).split())
            if text:
                node = next(n for n in [self.at, *self.at.above()] if n.tag != "a")
                self.blocks.append((node, text, sum(len(t) for t, linked in self.parts if linked)))
            self.parts = []

        def handle_starttag(self, tag, attrs):
            if tag != "a":
                self.end_block()
            self.at = Node(tag, self.at)
            self.all.append(self.at)

        def handle_endtag(self, tag):
            if tag != "a":
                self.end_block()
            self.at = self.at.up

        def handle_data(self, text):
            tags = [n.tag for n in [self.at, *self.at.above()]]
            if "nav" not in tags:
                self.parts.append((text, "a" in tags))

    tree = Tree()
    tree.feed(page)
    tree.end_block()
    textual = {"p", "li"}

    def inside(node, other):
        return other is node or other in node.above()

    def density(n):
        mine = [(len(t), k) for b, t, k in tree.blocks if inside(b, n)]
        total = sum(t for t, _ in mine)
        return (sum(k for _, k in mine) / total, total) if total else (1, 0)

    def score(n):
        out = 0.0
        for b, text, linked in tree.blocks:
            points = (1 + text.count(",") + min(len(text) / 100, 3)) * (1 - min(1, linked / len(text)))
            home = b.up if b.tag in textual else b
            chain = [home, *home.above()][:levels]
            if n in chain:
                at = chain.index(n)
                out += points * (1 if at == 0 else 0.5 if at == 1 else 1 / (3 * at))
        d, total = density(n)
        return out * ((1 - d) if total else 0) * (1.5 if n.tag == "article" else 1)

    scores = {id(n): score(n) for n in tree.all}
    best = max(range(len(tree.all)), key=lambda i: (scores[id(tree.all[i])], i))
    best = tree.all[best]
    if not tree.blocks or scores[id(best)] <= 0:
        return ""
    around = next((n for n in [best, *best.above()] if n.tag == "article"), None)
    if around is not None and scores[id(around)] >= 0.5 * scores[id(best)]:
        best = around
    keep = [best]
    if best.up is not None:
        for n in tree.all:
            if n.up is best.up and n is not best and density(n)[1]:
                d, total = density(n)
                if scores[id(n)] >= max(10, 0.2 * scores[id(best)]) or (n.tag in textual and (d < 0.25 and total > 80 or d == 0)):
                    keep.append(n)
    return "\n".join(t for b, t, _ in tree.blocks if any(inside(b, k) for k in keep))


def attention_score(model, passages):
    """The score of one bag, passage by passage."""
    import math

    encoded, weights = [], []
    for x in passages:
        x = [(v - m) / s for v, m, s in zip(x, model.mean, model.scale)]
        h = [math.tanh(sum(v * w for v, w in zip(x, column)) + b) for column, b in zip(model.encode.T, model.bias)]
        t = [math.tanh(sum(v * w for v, w in zip(h, column))) for column in model.tanh.T]
        g = [1 / (1 + math.exp(-sum(v * w for v, w in zip(h, column)))) for column in model.gate.T]
        encoded.append(h)
        weights.append(math.exp(sum(a * b * c for a, b, c in zip(t, g, model.attend))))
    mean = [sum(w * h[i] for w, h in zip(weights, encoded)) / sum(weights) for i in range(len(encoded[0]))]
    return 1 / (1 + math.exp(-(sum(m * o for m, o in zip(mean, model.out)) + model.out_bias[0])))


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def merkle(docs, fan=8):
    """{doc_id: (leaf, subroot, root, proof, folded_root)} for rows (doc_id, text, lang, source, n_chars) with ids that differ."""
    field = lambda x: "-" if x is None else f"{len(str(x).encode())}:{x}"
    leaf = lambda d, t, lang, s, n: digest(*map(field, (d, s, lang, n, t)))

    def tree(leaves):
        levels = [leaves]
        while len(levels[-1]) > 1:
            levels.append([digest(*levels[-1][i : i + fan]) for i in range(0, len(levels[-1]), fan)])
        return levels

    def path(levels, at):
        out = []
        for nodes in levels[:-1]:
            begin = at // fan * fan
            out.append((at - begin, nodes[begin : begin + fan]))
            at //= fan
        return out

    groups = defaultdict(list)
    for row in sorted(docs, key=lambda r: r[0]):
        groups[row[2]].append(row)
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {g: tree([leaf(*r) for r in groups[g]]) for g in names}
    top = tree([trees[g][-1][0] for g in names])
    out = {}
    for k, g in enumerate(names):
        for at, row in enumerate(groups[g]):
            steps = path(trees[g], at) + path(top, k)
            tampered = zlib.crc32(str(row[0]).encode()) % 3 == 0 and row[1] is not None
            node = leaf(row[0], lower(row[1]), *row[2:]) if tampered else leaf(*row)
            for place, run in steps:
                node = digest(*run[:place], node, *run[place + 1 :])
            proof = digest(*(x for place, run in steps for i, x in enumerate(run) if i != place))
            out[row[0]] = (trees[g][0][at], trees[g][-1][0], top[-1][0], proof, node)
    return out


RESAMPLED = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def resample(docs, target, longest=1, buckets=10_000, percent=10, least=20):
    """(doc_id, n_features, weight, score, rank) for rows (doc_id, text) with ids that differ."""
    words = lambda t: RESAMPLED.findall(lower(t or ""))
    grams = lambda w: [zlib.crc32(" ".join(w[i : i + n]).encode()) % buckets for n in range(1, longest + 1) for i in range(len(w) - n + 1)]
    texts = {d: words(t) for d, t in docs}
    s, t = Counter(b for w in texts.values() for b in grams(w)), Counter(b for x in target for b in grams(words(x)))
    all_s, all_t = sum(s.values()), sum(t.values())
    scored = {}
    for d, w in texts.items():
        g = [math.floor(1000 * math.log((t[b] + 1) * (all_s + buckets) / ((s[b] + 1) * (all_t + buckets)))) for b in grams(w)]
        h = int(hashlib.sha256(f"2024:{d}".encode()).hexdigest()[:8], 16)
        weight = sum(g) // len(g) if g else 0
        scored[d] = (len(g), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))))
    able = sorted((d for d, w in texts.items() if len(w) >= least), key=lambda d: (-scored[d][2], d))
    rank = {d: i + 1 for i, d in enumerate(able[: percent * len(able) // 100])}
    return [(d, *scored[d], rank.get(d)) for d in texts]


def later_bytes(docs, length=100):
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) for rows (doc_id, text) with ids that differ."""
    seen, out = set(), []
    for d, t in sorted(docs, key=lambda r: r[0]):
        data = (t or "").encode()
        gone = bytearray(len(data))
        for i in range(len(data) - length + 1):
            window = data[i : i + length]
            if window in seen:
                gone[i : i + length] = b"\1" * length
            seen.add(window)
        kept = bytes(b for b, g in zip(data, gone) if not g)
        out.append((d, len(data), sum(gone), len([s for s in bytes(gone).split(b"\0") if s]), hashlib.sha256(kept).hexdigest()))
    return out
