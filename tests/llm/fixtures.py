"""Small tables with the awkward cases, and brute-force versions in plain Python."""

import random
import re
from collections import Counter, defaultdict

WORD = re.compile("[^\x20\x09-\x0D]+")
LOWER = {i: i + 32 for i in range(65, 91)}
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, row string, key string, gram string"


def sentence(rng, n, vocabulary=4000):
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


def texts(seed=1):
    """Clean texts, exact and near copies, a shared passage, repeats, short, empty and null texts, one long text."""
    rng = random.Random(seed)
    out = [sentence(rng, rng.randrange(30, 200)) for _ in range(30)]
    base = sentence(rng, 150)
    out += [base, base, base + "  "]
    for k in range(12):
        words = base.split(" ")
        for _ in range(1 + k // 3):
            words[rng.randrange(len(words))] = "changed"
        out.append(" ".join(words))
    passage = sentence(rng, 60)
    out += [sentence(rng, 40) + "\n" + passage + "\n" + sentence(rng, 40) for _ in range(5)]
    out += ["x", "x", "one two three", "ONE two three", "", None, None, " \t\n", "a" * 700, "ab" * 300 + " " + "ab" * 300,
            "Größe été ñandú " * 30, "line of six words here now\n" * 8, sentence(rng, 9), "  　 .,. !!"]
    out += [sentence(rng, 20_000)]
    return out


def documents(spark, seed=1, rows=None):
    """With extra columns whose names clash with those inside the operators, a repeated row and a null id."""
    rows = texts(seed) if rows is None else rows
    data = [(i * 7 % 1009, t, "en", None if i % 11 == 0 else f"s{i % 4}", None if t is None else len(t), "r", "k", "g")
            for i, t in enumerate(rows)]
    return spark.createDataFrame(data, SCHEMA).repartition(3)


def awkward(spark):
    df = documents(spark)
    return df.unionByName(df.filter("doc_id = 7")).unionByName(spark.createDataFrame([(None, "no id at all here", None, None, 1, "", "", "")], SCHEMA))


def words(text, lower=False):
    return WORD.findall((text or "").translate(LOWER) if lower else (text or ""))


def shingles(text, n=5):
    w = words(text, True)
    return frozenset(tuple(w[i:i + n]) for i in range(len(w) - n + 1)) if len(w) >= n else frozenset([tuple(w)] if w else [])


class Sets:
    def __init__(self):
        self.up = {}

    def find(self, x):
        self.up.setdefault(x, x)
        while self.up[x] != x:
            self.up[x] = self.up[self.up[x]]
            x = self.up[x]
        return x

    def join(self, a, b):
        a, b = sorted((self.find(a), self.find(b)))
        self.up[b] = a


def linked(sets, ids, num=80, den=100):
    """Smallest id reachable over pairs of sets with intersection/union >= num/den."""
    groups, index = Sets(), defaultdict(list)
    for i, s in enumerate(sets):
        common = Counter(j for g in s for j in index[g])
        for j, c in common.items():
            if den * c >= num * (len(s) + len(sets[j]) - c):
                groups.join(i, j)
        for g in s:
            index[g].append(i)
    smallest = {}
    for i in range(len(sets)):
        r = groups.find(i)
        smallest[r] = min(smallest.get(r, ids[i]), ids[i])
    return [smallest[groups.find(i)] for i in range(len(sets))]
