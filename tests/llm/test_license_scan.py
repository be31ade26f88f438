import math
import re
from collections import Counter

from atende.llm import license_scan as s

FILES = [
    ("a/LICENSE", "Permission is hereby granted, free of charge, to any person obtaining a copy under the MIT License"), ("a/b/c.py", "print(1)"), ("a/b/d/e.py", "x"),
    ("a/b/f.py", "text\nLicensed under the Apache License, Version 2.0.\nmore text of the file, much longer than its licence line"), ("z/q.py", "plain"),
    ("a/b/d/COPYING", "licensed under the GNU General Public License, version 3"), ("top.md", "no cue"), (None, "All rights reserved."), (None, None), ("n/m.txt", None),
    ("n/m.txt", None), ("", ""), ("odd/x.txt", "our licensee list is on the copyright page of the other volume"), ("k/NOTICE.txt", "Copyright notice with All rights reserved."),
    ("k/LICENSE.md", "Released under the MIT License."), ("k/l/m/n/o.txt", "deep"), ("a/bc/x.py", "sibling"), ("mostly/y", "Licensed under CC BY-NC 4.0."),
]


def brute_units(text, named):
    """Sentences of the lines and of the text, and windows of words of the long ones."""
    near = lambda units: [u for u in units if named or re.search(s.CUE, u)]
    sentences = near([*re.split(s.SENTENCE_END, text), *(u for line in text.split("\n") for u in re.split(s.SENTENCE_END, line))])
    cut = []
    for u in sentences:
        words = u.split()
        if len(words) > s.WINDOWS[0][0]:
            cut += [" ".join(words[at: at + size]) for size, step in s.WINDOWS for at in range(0, max(0, len(words) - size + step - 1) + 1, step)]
    return set(sentences + near(cut))


def brute(files):
    named = lambda p: bool(p is not None and re.search(s.FILE_NAMES.replace(r"\z", r"\Z"), p.split("/")[-1]))
    cues = lambda t: " ".join(x for x in t.split("\n") if re.search(s.CUE, x))
    head = lambda p, t: (t or "" if named(p) else cues(t or "")) or None
    words = lambda t: [w for w in re.split(r"[^a-z0-9]+", t.lower()) if w]
    heads = {head(p, t) for p, t in files} - {None}
    bags = [Counter(words(h)) for h in heads] + [Counter(words(t)) for _, t in s.TEMPLATES]
    df = Counter(w for b in bags for w in b)
    weigh = lambda t: {w: n * (math.log((1 + len(bags)) / (1 + df[w])) + 1) for w, n in Counter(words(t)).items()}
    norm = lambda v: math.sqrt(sum(x * x for x in v.values()))

    def best(h):
        v, out = weigh(h), []
        for name, t in s.TEMPLATES:
            u = weigh(t)
            out += [(-round(sum(v[w] * u.get(w, 0) for w in v) / norm(v) / norm(u), 6), name)] if v else []
        c, name = min(out, default=(0, None))
        return (name, -c) if -c >= s.LEAST_COSINE else None

    def verdict(p, t):
        """(licence, cosine, characters that name it) of a file by itself."""
        h = head(p, t)
        if h is None:
            return None
        own = best(h)
        if own is None or own[0] == s.RESERVED:
            scored = [(x[0] == s.RESERVED, -x[1], x[0], -len(u)) for u in brute_units(t, named(p)) if (x := best(u))]
            if scored and (own is None or not min(scored)[0]):
                _, c, name, n = min(scored)
                return name, -c, -n
        return own and (*own, len(h))

    own = [verdict(p, t) for p, t in files]
    declared = {}
    for (p, t), v in zip(files, own):
        if p is not None and v and (named(p) or 2 * v[2] >= len(t)):
            d = "/".join(p.split("/")[:-1])
            declared[d] = min(declared.get(d, (0, "~")), (-v[1], v[0]))
    out = []
    for (p, _), v in zip(files, own):
        if v:
            out.append((p, *v[:2], "header", None))
            continue
        parts = (p or "").split("/")[:-1]
        up = [d for n in range(len(parts), -1, -1) if (d := "/".join(parts[:n])) in declared] if p is not None else []
        out.append((p, declared[up[0]][1], -declared[up[0]][0], "inherited", up[0]) if up else (p, None, None, "none", None))
    return out


def test_against_brute_force(spark):
    files = [*FILES, ("whole/LICENSE", MIT), ("whole/x.c", "int x;"), ("long/a.txt", PROSE * 300 + "Released under the MIT License. " + PROSE * 300), ("prose/b.txt", PROSE)]
    df = spark.createDataFrame([(p, t, "x") for p, t in files], "path string, text string, licence string")
    result = s.license_scan(df)
    assert sorted(map(repr, map(tuple, result.collect()))) == sorted(map(repr, brute(files)))
    assert s.license_scan(df.where("false")).count() == 0


def test_plan_is_native(spark):
    df = spark.createDataFrame([(p, t) for p, t in FILES], "path string, text string")
    plan = s.license_scan(df)._jdf.queryExecution().executedPlan().toString()
    assert not any(w in plan for w in ("Python", "Pandas", "ArrowEval"))


BSD = """Copyright (c) 2019, A. Person
All rights reserved.

Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this list of conditions."""
MIT = """Copyright (c) 2020 A. Person

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, subject to the following conditions:"""
PROSE = "the sea was calm that day and nobody in the harbour had seen a ship since the long winter of the year before "


def test_bodies_of_licence_files_and_sentences_in_prose(spark):
    files = {
        "bsd/LICENSE": (BSD, "BSD-3-Clause"), "mit/LICENSE.txt": (MIT, "MIT"), "body/COPYING": (BSD.split("\n\n")[1], "BSD-3-Clause"),
        "prose/a.txt": (PROSE * 4 + "Ended. Released under the MIT License. " + PROSE * 4, "MIT"),
        "prose/b.txt": (PROSE * 4 + "licensed under the Apache License, Version 2.0 " + PROSE * 4, "Apache-2.0"),
        "wrapped/c.py": ("# Copyright 2020 A. Person. All rights reserved.\n# Licensed under the GNU Lesser General\n# Public License, version 3.\n" + PROSE, "LGPL-3.0"),
        "none/d.txt": (PROSE * 3, None), "reserved/e.txt": (PROSE + "\nCopyright. All rights reserved.", "proprietary"),
    }
    df = spark.createDataFrame([(p, t) for p, (t, _) in files.items()], "path string, text string")
    got = {r["path"]: (r["licence"], r["how"]) for r in s.license_scan(df).collect()}
    assert got == {p: (x, "header" if x else "none") for p, (_, x) in files.items()}


def test_a_licence_line_beside_other_cue_lines_counts_and_declares_nothing(spark):
    files = [("a/LICENSE", FILES[0][1]), FILES[3], ("a/b/c.py", "print(1)")]
    got = {r["path"]: tuple(r)[1:] for r in s.license_scan(spark.createDataFrame(files, "path string, text string")).collect()}
    assert got["a/b/f.py"] == ("Apache-2.0", 1.0, "header", None)
    assert got["a/b/c.py"][0::2] == ("MIT", "inherited") and got["a/b/c.py"][3] == "a"
