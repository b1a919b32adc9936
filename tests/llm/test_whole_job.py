"""What the operators must not leave out."""

import math
import random

from catalytics.llm import automata, licence_scan, secrets, url_filter

PAGES = "page_id long, url string, html string"


# 1
def test_links_without_a_scheme(spark):
    pages = [(1, "https://a.org/x", '<a href="//B.net/p?u=http://c.net/">'), (2, "http://b.net/", '<a href="/c.net">'), (3, "http://c.net/", "")]
    got = {r.page_id: r for r in url_filter.judge(spark.createDataFrame(pages, PAGES)).collect()}
    assert math.isclose(got[2].trust, (1 - url_filter.DAMPING) * url_filter.DAMPING)
    assert got[3].trust == 0


def test_propagation_until_nothing_changes(spark):
    # twelve hosts in a row link to a blocked one; two hosts link to each other
    hosts = [f"h{i}.net" for i in range(12)] + ["example.org"]
    pages = [(i, f"http://{h}/es/", f'<a href="http://{hosts[i + 1]}/">' if i < 12 else "") for i, h in enumerate(hosts)]
    got = {r.page_id: r for r in url_filter.judge(spark.createDataFrame(pages, PAGES)).collect()}
    assert [got[i].verdict for i in range(13)] == ["block"] * 13
    d = url_filter.DAMPING
    assert math.isclose(got[0].distrust, (1 - d) * d**12)

    links = spark.createDataFrame([("a", "b", 1), ("b", "a", 1)], "source string, target string, links long")
    seeds = spark.createDataFrame([("a", 1.0, 0.0)], "host string, allowed double, blocked double")
    trust = {r.host: r.trust for r in url_filter.propagate(links, seeds, tolerance=1e-3).collect()}
    assert abs(trust["a"] - 1 / (1 + d)) < 1e-2 and abs(trust["b"] - d / (1 + d)) < 1e-2


# 6
def test_wrapped_licences(spark):
    bsd = "// Redistribution and use in source and binary forms, with or without\n// modification, are permitted provided that the following conditions\n// are met:"
    apache = " * Unless required by applicable law or agreed to in writing, software\n * distributed under the License is distributed on an \"AS IS\" BASIS,"
    gpl = "dnl This program is free software; you can redistribute it and/or modify\ndnl it under the terms of the GNU General Public License as published by\ndnl the Free Software Foundation"
    narrow = "\n".join("Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files".split())
    texts = [bsd, apache, gpl, narrow, f"int a;\n{bsd}\n//\n{apache}\nint b;", bsd.replace("// ", "\n\n")]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: (r.licences, r.n_licences) for r in licence_scan.scan(frame).collect()}
    assert [got[i] for i in range(5)] == [(["bsd"], 1), (["apache"], 1), (["gpl"], 1), (["mit"], 1), (["apache", "bsd"], 2)]
    assert got[5] == ([], 0)


def test_licences_between_unlisted_ones(spark):
    unlisted = ["SPDX-License-Identifier: Zlib", "SPDX-License-Identifier: LGPL-2.1-or-later", "a licence of our own"]
    listed = {"MIT": "mit", "GPL-2.0-only": "gpl", "Apache-2.0": "apache", "CC-BY-4.0": "cc", "BSD-3-Clause": "bsd", "MPL-2.0": "mpl"}
    texts = [f"# SPDX-License-Identifier: {x}\nbody {i}" for i, x in enumerate(listed)] + ["Released under the MIT License.\nLicensed under the MIT License."]
    texts += unlisted + [f"{x}, see part {i} of the licensed text" for i, x in enumerate(unlisted * 40)]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: (r.licences, r.n_licences) for r in licence_scan.scan(frame).collect()}
    assert [got[i] for i in range(7)] == [([x], 1) for x in listed.values()] + [(["mit"], 2)]
    assert all(got[i] == ([], 0) for i in range(7, len(texts)))


def test_ordinary_lines_are_different_ones(spark):
    frame = spark.createDataFrame([(i, f"the same line\nline number {i}\nSPDX-License-Identifier: MIT") for i in range(40)], "doc_id long, text string")
    rows = [" ".join(r.tokens) for r in licence_scan.ordinary(frame, sample=30).collect()]
    assert len(rows) == len(set(rows)) == 30 and not any("spdx" in r for r in rows)


# 7
def test_formats_of_other_lengths():
    rng = random.Random(3)
    url = lambda n: "".join(rng.choices(secrets._URL, k=n))
    models = automata.learn_all(secrets.made_examples())
    tokens = [f"eyJhbGciOiJ{url(a)}a.eyJ{url(b)}a.{url(c)}a" for a, b, c in ((16, 20, 42), (50, 300, 85), (120, 1500, 341))]
    tokens += ["xoxb-1234567890-1234567890123-" + "aB3d" * 6, "sk_live_" + "x7Yq2" * 18]
    tokens += ["AIza" + url(33) + "-_", "glpat-" + url(19) + "_"]
    for token in tokens:
        assert secrets.all_spans(f"see {token} ok", models) == [(4, 3, 4 + len(token))], token
    assert secrets.all_spans("see " + tokens[3] + ". ok", models) == [(4, 3, 4 + len(tokens[3]))]
    assert secrets.all_spans("some_ordinary_name_2024 version-1.2.3-of-this", models) == []


def test_every_kind_has_examples(spark):
    texts = [" ".join(f"{(i * 50 + j) * 7919:032x}" for j in range(50)) for i in range(40)] + [f"password=Ab{i:04d}cd" for i in range(30)]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    kinds = [k for k, _ in secrets.labelled(frame, sample=100)]
    assert (kinds.count("hex"), kinds.count("assign"), kinds.count("access")) == (100, 30, secrets.LEAST)
    models = automata.learn_all(secrets.labelled(frame.limit(0)))
    assert set(models) == {*secrets.FORMATS, "assign", "access", "hex"}
