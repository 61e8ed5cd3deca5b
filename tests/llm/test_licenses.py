import math
from collections import Counter

from helpers import empty_docs, odd_docs

from tidemark.llm.licenses import TEMPLATES, THRESHOLD, Weights, document_paths, plain_words, scan_licences, vocabulary


def brute_line(line, w):
    tf = Counter(plain_words(line))
    norm = math.sqrt(sum((c * w.idf.get(x, w.unknown)) ** 2 for x, c in tf.items()))
    if not norm:
        return (0.0, "")
    return max((round(sum(c * w.idf[x] * v[x] for x, c in tf.items() if x in v) / norm, 6), name) for name, v in w.vectors)


def brute(files):
    n, counts = len(files), Counter(x for _, _, t in files for x in set(plain_words(t or "")))
    w = Weights(TEMPLATES, n, {x: counts[x] for x in vocabulary(TEMPLATES)})
    own, top = {}, {}
    for _, path, text in files:
        ls = (text or "").split("\n")
        first = next((i for i, x in enumerate(ls) if x.strip()), None)
        for i, line in enumerate(ls):
            score, name = brute_line(line, w)
            if score >= THRESHOLD:
                own[path] = max(own.get(path, (0, 0, "")), (score, -i, name))
                if i == first:
                    top[path] = True
    out = []
    for d, path, _ in files:
        if path in own:
            out.append((d, path, own[path][2], "own"))
            continue
        folder, found = path.rpartition("/")[0] or ".", None
        while True:
            here = sorted(p for p in top if (p.rpartition("/")[0] or ".") == folder)
            if here:
                found = own[here[0]][2]
                break
            if folder == ".":
                break
            folder = folder.rpartition("/")[0] or "."
        out.append((d, path, found, "inherited" if found else None))
    return sorted(out, key=repr)


FILES = [
    (1, "LICENSE", "MIT here\nplain"), (2, "a/LICENSE", "\n  Released under the MIT License.\nmore"), (3, "a/b/x.c", "int x"), (4, "a/b/c/y.c", "int y"),
    (5, "a/b/c/LICENSE", "Licensed under the Apache License, version 2.0"), (6, "a/b/c/d/z.c", "z"), (7, "q/w.c", "w\nAll rights reserved."), (8, "q/v.c", "v"),
    (9, "a/own.c", "code\nLicensed under CC BY-NC 4.0.\nThis work is licensed under the GNU General Public License, version 3."), (10, "top.c", ""), (11, "a/b/z.c", None),
    (12, "a/license", "All rights reserved"), (13, "q/almost", "all the rights of us were never reserved for any of the others"),
    (14, "a/b/x.c", "int x"),
]


def test_equals_brute_force(spark):
    df = spark.createDataFrame(FILES, "doc_id long, path string, text string").repartition(3)
    got = [(r["doc_id"], r["path"], r["license"], r["origin"]) for r in scan_licences(df).collect()]
    assert sorted(got, key=repr) == brute(FILES)
    by = {g[0]: g[2:] for g in got}
    assert by[4] == ("Apache-2.0", "inherited") and by[3] == ("MIT", "inherited") and by[7] == ("LicenseRef-proprietary", "own") and by[8] == (None, None)


def test_a_line_without_anchor_words_stays_below_the_threshold():
    w = Weights(TEMPLATES, 1000, {"the": 900, "under": 400, "of": 900})
    for name, v in w.vectors:
        rest = [x for x in v if x not in w.anchors]
        assert math.sqrt(sum(v[x] ** 2 for x in rest)) < THRESHOLD, name


def test_odd_rows(spark):
    docs = odd_docs(spark, ["Released under the MIT License.\ncode", "code"])
    out = scan_licences(document_paths(docs))
    assert out.count() == docs.count()
    by = {r["doc_id"]: (r["license"], r["origin"]) for r in out.collect()}
    assert by[0] == ("MIT", "own") and by[1] == ("MIT", "inherited")
    assert scan_licences(document_paths(empty_docs(spark))).count() == 0


def test_one_directory_with_most_files(spark):
    files = [(i, f"hot/f{i:04d}", "Released under the MIT License." if i == 0 else f"code {i}") for i in range(300)]
    out = scan_licences(spark.createDataFrame(files, "doc_id long, path string, text string"))
    assert out.filter("license = 'MIT'").count() == 300
