from ledgerline.llm import licenses
from llm_data import ODD, clashing, documents


def test_headers_files_and_inheritance(spark):
    mit = "Released under the MIT License."
    apache = "Licensed under the Apache License, Version 2.0."
    rows = [("a/LICENSE", "some text\n" + mit), ("a/x.c", "int main"), ("a/b/y.c", None), ("a/b/z.c", "code\n" + apache + "\nmore"),
            ("a/c/whole", apache), ("a/c/d/e/deep", ""), ("other/f", "the work of this version is public"), ("top", "x"),
            (None, "y"), ("a/x.c", "int again"), ("other/g", "license " * 5), ("other/h", "word " * 200_000 + mit)]
    df = spark.createDataFrame(rows, "path string, text string")
    got = {r.path: (r.license, r.basis, r.origin) for r in licenses.scan_licenses(df).collect()}
    assert got == {
        "a/LICENSE": ("MIT", "file", None), "a/x.c": ("MIT", "inherited", "a"), "a/b/y.c": ("MIT", "inherited", "a"),
        "a/b/z.c": ("Apache-2.0", "header", None), "a/c/whole": ("Apache-2.0", "file", None),
        "a/c/d/e/deep": ("Apache-2.0", "inherited", "a/c"), "other/f": (None, None, None), "top": (None, None, None),
        None: (None, None, None), "other/g": (None, None, None), "other/h": (None, None, None)}


def test_documents(spark):
    texts = ODD[:-1] + ["x\nReleased under the MIT License.", "This work is licensed under the GNU General Public License, version 3."]
    df = clashing(documents(spark, texts, sources=["s", None] * (len(texts) // 2)))
    rows = licenses.op5(df).collect()
    assert len(rows) == len(texts)
    assert {(r.license, r.basis) for r in rows if r.basis in ("file", "header")} == {("MIT", "header"), ("GPL-3.0", "file")}
    assert licenses.op5(df.limit(0)).count() == 0
    assert licenses.op5(df.union(df)).count() == 2 * len(texts)


def brute(rows):
    """path -> (licences of the best score, score, basis, origin) by the
    definitions, file by file. Scores that agree to nine digits are one score."""
    import math
    import re
    from collections import Counter
    lines = [x for _, t in rows if t is not None for x in t.split("\n")]
    df = Counter(t for x in lines for t in set(licenses.terms(x)))
    idf = {t: math.log((len(lines) + 1) / (df[t] + 1)) + 1 for t in licenses.VOCABULARY}
    unseen = math.log(len(lines) + 1) + 1

    def vector(text):
        v = {t: n * idf.get(t, unseen) for t, n in Counter(licenses.terms(text)).items()}
        norm = math.sqrt(sum(x * x for x in v.values()))
        return {t: x / norm for t, x in v.items()}
    templates = [(name, vector(text)) for name, text in licenses.TEMPLATES]

    def best(text):
        v = vector(text)
        scores = [(round(sum(v.get(t, 0) * x for t, x in w.items()), 9), name) for name, w in templates]
        return max(scores)[0], {n for x, n in scores if x == max(scores)[0]}

    def better(old, new):
        """Of (..., score, licences): the greater, or both sets' union."""
        if old is None or new[:-1] > old[:-1]:
            return new
        return old if new[:-1] < old[:-1] else (*old[:-1], old[-1] | new[-1])
    own, holders, out = {}, {}, {}
    for path, text in rows:
        named = bool(re.match(r"(licen[sc]e|copying|notice|unlicense)([._-].*)?$", (path or "").split("/")[-1], re.I))
        for k, x in [(-1, text), *enumerate(text.split("\n"))] if text is not None else []:
            score, found = best(x)
            whole = (k == -1 and score >= licenses.FILE) or (k >= 0 and named)
            if score >= licenses.HEADER and (whole or k >= 0):
                own[path] = better(own.get(path), (whole, score, found))
    up = lambda p: None if p is None else p.rpartition("/")[0]
    for path, (whole, score, found) in own.items():
        if whole and path is not None:
            holders[up(path)] = better(holders.get(up(path)), (score, found))
    for path, _ in rows:
        at, origin = up(path), None
        while at is not None and origin is None:
            origin, at = (at if at in holders else None), (up(at) if at else None)
        whole, score, found = own.get(path, (False, None, None))
        inherited = None if origin is None else holders[origin][1]
        out[path] = (found or inherited or {None}, score,
                     "file" if whole else "header" if found else "inherited" if inherited else None, None if found else origin)
    return out


def test_equals_brute_force(spark):
    import random
    for seed in range(3):
        r = random.Random(seed)

        def line():
            kind, words = r.random(), r.choice(licenses.TEMPLATES)[1].split()
            if kind < 0.3:
                return " ".join(words)
            if kind < 0.6:
                return " ".join(w if r.random() < 0.8 else r.choice(["lorem", "free", "software", "x1"]) for w in words)
            return " ".join(r.choice(["lorem", "ipsum", "license", "the", "code", "version"]) for _ in range(r.randrange(9)))
        names = ["LICENSE", "copying.txt", "a.py", "b.py", "notice-x", "README"]
        rows = [(r.choice(["", "p/", "p/q/", "p/q/r/", "s/", "s/t/u/"]) + r.choice(names), None if r.random() < 0.05 else
                 "\n".join(line() for _ in range(r.choice([1, 1, 2, 4])))) for _ in range(60)]
        df = spark.createDataFrame(rows, "path string, text string")
        got = {x.path: (x.license, None if x.score is None else round(x.score, 9), x.basis, x.origin)
               for x in licenses.scan_licenses(df).collect()}
        want = brute(rows)
        assert {p: x[1:] for p, x in got.items()} == {p: x[1:] for p, x in want.items()}
        assert all(x[0] in want[p][0] for p, x in got.items())
