import math
import re

from pyspark.sql import functions as F

from quern.llm.licences import FULL_TEXTS, TEMPLATES, THRESHOLD, noticed, scan_licences, weight
from quern.llm.queries import QUERIES
from tests.llm.data import TEXTS, documents, prose

APACHE, MIT = TEMPLATES["Apache-2.0"], TEMPLATES["MIT"]


def split(text):
    return [w for w in re.split("[^a-z0-9]+", (text or "").lower()) if w]


def brute(rows):
    """Row number -> (licence, from, directory), by comparing every line with every template."""
    bags = {name: set(split(t)) for name, t in TEMPLATES.items()}
    vocabulary = set().union(*bags.values())
    holders = {w: sum(w in split(t) for i, _, t in rows if i is not None) for w in vocabulary}
    total = sum(i is not None for i, _, _ in rows)
    weights = {w: weight(total, n) for w, n in holders.items()}

    def length(bag):
        return sum(weights.get(w, weight(total, 0)) ** 2 for w in bag)

    def best_line(text):
        found, header = [], False
        seen = False
        for n, line in enumerate((text or "").split("\n")):
            bag = set(split(line))
            scores = [
                (-sum(weights[w] ** 2 for w in bag & own) / math.sqrt(length(bag) * length(own)), name)
                for name, own in sorted(bags.items()) if bag
            ]
            if scores and -min(scores)[0] >= THRESHOLD:
                found.append((min(scores)[0], n, min(scores)[1]))
                header = header or not seen
            seen = seen or bool(bag)
        return (min(found), header) if found else (None, False)

    own, files, dirs = {}, {}, {}
    for i, path, text in rows:
        found, header = best_line(text)
        if i is not None and found:
            own[i] = min(own.get(i, found), found)
            files[i] = files.get(i, False) or header
    for i, path, _ in rows:
        if i in own and files[i] and path and "/" in path:
            d = path.rpartition("/")[0]
            rank = (own[i][0], i, own[i][2])
            dirs[d] = min(dirs.get(d, rank), rank)
    out = []
    for i, path, _ in rows:
        if i in own:
            out.append((str(i), str(path), own[i][2], "own", None))
            continue
        d = path.rpartition("/")[0] if path and "/" in path else None
        while d is not None and d not in dirs:
            d = d.rpartition("/")[0] if "/" in d else None
        out.append((str(i), str(path), dirs[d][2] if d is not None else None, "inherited" if d is not None else "none", d))
    return sorted(out, key=str)


def result(df):
    rows = df.collect()
    return sorted(((str(r.doc_id), str(r.path), r.licence, r.licence_from, r.licence_dir) for r in rows), key=str)


ROWS = [
    (1, "a/LICENSE", f"\n  \n{APACHE}\n{prose(50)}"), (2, "a/x", prose(40)), (3, "a/b/x", prose(40)),
    (4, "a/b/c/LICENSE", f"{MIT}.\n"), (5, "a/b/c/d/x", ""), (6, "a/b/y", f"{prose(30)}\n{TEMPLATES['GPL-3.0']}."),
    (7, "e/x", None), (8, "top", prose(9)), (9, None, prose(9)), (None, "a/b/c/n", MIT), (10, "a/b/LICENSE", f"// {MIT}"),
    (10, "a/b/LICENSE", f"// {MIT}"), (11, "f/L", APACHE), (12, "f/L2", MIT), (13, "f/z", "license mit"), (14, "/g/L", MIT),
    (15, "/g/h/x", "apache"), (16, "ab/x", "none"), (17, "a//x", "none"), (18, "f/q", "The MIT cafe " * 500),
    (19, "k/x", f"{TEMPLATES['CC-BY-NC-4.0']}\n{TEMPLATES['CC-BY-4.0']}"), (20, "k/y", TEMPLATES["CC-BY-4.0"].upper()),
]


def test_same_as_comparing_every_line(spark):
    df = spark.createDataFrame(ROWS, "doc_id bigint, path string, text string").selectExpr("*", "1 AS Licence", "2 AS dir")
    got = scan_licences(df, "path")
    assert {"text", "dir", "licence", "licence_score", "licence_from", "licence_dir"} <= set(got.columns)
    assert result(got) == brute(ROWS)
    assert scan_licences(df.limit(0), "path").count() == 0


def test_awkward_texts(spark):
    rows = [(i, f"p/{k}", t) for k, (i, t) in enumerate(TEXTS)]
    df = documents(spark).withColumn("path", F.lit("p/x"))
    assert scan_licences(df, "path").count() == len(TEXTS)
    assert result(scan_licences(spark.createDataFrame(rows, "doc_id bigint, path string, text string"), "path")) == brute(rows)


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    got = QUERIES["op5_licence_scan"](spark, sf)
    paths = {r.doc_id: r.path for r in got.collect()}
    texts = spark.read.parquet(f"{sf}/documents.parquet").collect()
    assert result(got) == brute([(r.doc_id, paths[r.doc_id], r.text) for r in texts])


def test_licence_files_without_a_header(spark):
    rows = [
        (1, "a/note", f"{prose(4)}\n{MIT}."), (2, "a/x", prose(40)), (3, "b/COPYING.txt", f"{prose(30)}\n{APACHE}"),
        (4, "b/c/x", prose(40)), (5, "c/long", f"{prose(30)}\n{APACHE}"), (6, "c/x", prose(40)), (7, "d/LICENSE", prose(30)),
        (8, "d/x", prose(40)), (9, "e/licensed", f"{prose(30)}\n{APACHE}"), (10, "e/x", prose(40)),
    ]
    got = scan_licences(spark.createDataFrame(rows, "doc_id bigint, path string, text string"), "path").collect()
    inherited = {r.doc_id: (r.licence, r.licence_dir) for r in got if r.licence_from == "inherited"}
    assert inherited == {2: ("MIT", "a"), 4: ("Apache-2.0", "b")}


def test_query_inherits(spark):
    rows = QUERIES["op5_licence_scan"](spark, "/root/testdata/sf0.1").collect()
    own = {r.doc_id: r for r in rows if r.licence_from == "own"}
    inherited = [r for r in rows if r.licence_from == "inherited"]
    assert inherited and all((r.path + "/").startswith(r.licence_dir + "/") for r in inherited)
    held = {(o.path.rpartition("/")[0], o.licence) for o in own.values()}
    assert all((r.licence_dir, r.licence) in held for r in inherited)


def test_other_wordings_and_wrapped_headers(spark):
    gpl = FULL_TEXTS["GPL-3.0"][0].replace("redistribute", "redistribute\n *").replace("Foundation", "\n * Foundation")
    mit = FULL_TEXTS["MIT"][-1].replace("associated", "associated\n").replace("limitation", "\nlimitation")
    rows = [
        (1, "a/1", "This project is released under the MIT License.", "MIT"), (2, "b/2", "The MIT License (MIT)", "MIT"),
        (3, "c/3", "This software is licensed under the MIT License", "MIT"),
        (4, "d/4", "This document is licensed under CC BY 4.0 by its author", "CC-BY-4.0"),
        (5, "e/5", f"/* {gpl}. */\n{prose(60)}", "GPL-3.0"), (6, "f/6", f"Copyright (c) 2020 Q\n\n{mit}, and so on", "MIT"),
        (7, "g/7", f"{prose(50)}\n# Licensed under the Apache\n# License, Version 2.0\n{prose(70)}", "Apache-2.0"),
        (8, "h/8", f"Copyright 2020 Q. All rights reserved.\n{APACHE}", "Apache-2.0"),
        (9, "i/9", f"{prose(20)}\nCopyright 2020 Q. All rights reserved.", "All-Rights-Reserved"),
        (10, "j/10", "license mit", None), (11, "k/11", prose(300), None), (12, "l/12", f"{gpl} " * 40 + prose(900), "GPL-3.0"),
    ] + [(i, f"m{i}/x", prose(80, i)) + (None,) for i in range(20, 400)]
    df = spark.createDataFrame([r[:3] for r in rows], "doc_id bigint, path string, text string")
    got = {r.doc_id: (r.licence, r.licence_from) for r in scan_licences(df, "path").collect()}
    assert got == {i: (name, "own" if name else "none") for i, _, _, name in rows}


def test_reserved_rights_are_not_passed_over(spark):
    rows = [
        (1, "a/LICENSE", MIT), (2, "a/x", f"{prose(30)}\nAll rights reserved."), (3, "a/b/LICENSE", "All rights reserved."),
        (4, "a/b/x", prose(30)), (5, "a/y", prose(30)), (6, "a/z", "All rights reserved."),
    ]
    df = spark.createDataFrame(rows, "doc_id bigint, path string, text string")
    got = {r.doc_id: r.licence for r in scan_licences(df, "path").collect()}
    reserved = "All-Rights-Reserved"
    assert got == {1: "MIT", 2: reserved, 3: reserved, 4: reserved, 5: "MIT", 6: reserved}


def test_words_are_split_once(spark, capsys):
    """Filters on the words of a text must not be replaced by the expression that splits it."""
    df = spark.createDataFrame(ROWS, "doc_id bigint, path string, text string")
    noticed(df, "doc_id", "text", ["a", "mit", "the"], ["mit"]).explain("extended")
    optimized = capsys.readouterr().out.split("== Optimized Logical Plan ==")[1].split("== Physical Plan ==")[0]
    assert optimized.count("split(lower(") == 1
