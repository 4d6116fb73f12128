"""License scans: MinHash bands over overlapping windows retrieve templates, exact containment verifies.

Texts become lower-case runs of letters and digits, and these become hashes of five in a row.  A class holds the templates
of up to 2^x shingles; its windows hold 2^(x+1) and start every 2^x, so a quoted template lies whole in one window.  The least
Jaccard similarity of the two at the containment asked for follows from the sizes (``similarity``; 0.19 to 0.5).  Signatures have
bands of one row, as many as a class needs for a chance below ``MISSED`` that no band agrees (``bands``).  A candidate counts when the window holds at least
80 % of the template's shingles, exactly.  Windows that hold no shingle of any template can't and are not signed.

All of it is array functions inside the document row: no shuffle, no user functions, no join.

Defined results: a null or blank text has no license; repeated rows each get their row; an empty table gives no
rows; other columns are ignored.
"""

from __future__ import annotations

import math
from collections import defaultdict

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkweave.llm.common import fenced

SHINGLE = 5
CONTAINMENT = 80
#: Chance, at most, that a template in a window is not retrieved.
MISSED = 1e-6

#: Notices and openings of public licenses (fixed values).
TEMPLATES = {
    "apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "apache-2.0-header": (
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. '
        "You may obtain a copy of the License at"
    ),
    "bsd": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    "cc-by-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "cc-by-nc-4.0": "Licensed under CC BY-NC 4.0.",
    "gpl-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "gpl-header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as "
        "published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."
    ),
    "isc": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted",
    "mit": "Released under the MIT License.",
    "mit-header": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files "
        '(the "Software"), to deal in the Software without restriction'
    ),
    "mpl-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
}


def step(n: int) -> int:
    """Where windows start for a template of ``n`` shingles: its class, half a window."""
    return 1 << (n - 1).bit_length()


def similarity(n: int) -> float:
    """Least Jaccard similarity of a template of ``n`` shingles and a window that holds enough of them."""
    held = -(-n * CONTAINMENT // 100)
    return held / (n + 2 * step(n) - held)


def bands(n: int) -> int:
    return math.floor(math.log(MISSED) / math.log1p(-similarity(n))) + 1


def _shingles(words: str) -> str:
    """SQL: hashes of five words in a row of an array column."""
    hashed = ", ".join(["w", *(f"get({words}, i + {k})" for k in range(1, SHINGLE))])
    return f"transform(slice({words}, 1, greatest(size({words}) - {SHINGLE - 1}, 0)), (w, i) -> xxhash64({hashed}))"


def _words(text: str) -> str:
    return f"filter(split(lower({text}), '[^a-z0-9]+'), w -> w != '')"


def _signature(shingles: str, count: int) -> str:
    """SQL: the smallest of the shingles' hashes under each of ``count`` hash functions."""
    return f"transform(sequence(1, {count}), b -> array_min(transform({shingles}, h -> xxhash64(h, b))))"


def template_rows(spark: SparkSession, templates: dict[str, str] = TEMPLATES) -> list:
    """``(name, shingles, signature)`` of each template, by the expressions that texts go through; a row a template."""
    df = spark.createDataFrame(sorted(templates.items()), "name string, text string").withColumn("_w", F.expr(_words("text")))
    df = df.withColumn("shingles", F.expr(f"array_distinct({_shingles('_w')})"))
    if short := [r["name"] for r in df.filter("size(shingles) = 0").collect()]:
        raise ValueError(f"templates of fewer than {SHINGLE} words: {short}")
    sizes = [r["n"] for r in df.select(F.size("shingles").alias("n")).distinct().collect()]
    count = max(map(bands, sizes), default=1)
    return df.withColumn("signature", F.expr(_signature("shingles", count))).select("name", "shingles", "signature").collect()


def scan(docs: DataFrame, key: str = "doc_id", text: str = "text", templates: dict[str, str] = TEMPLATES) -> DataFrame:
    """``(key, licenses)`` for every row: array of (word, name) of each verified match, ``word`` where its window starts."""
    rows = template_rows(docs.sparkSession, templates)
    longs = lambda values: "array(" + ", ".join(f"{v}L" if v != -(1 << 63) else "bigint('-9223372036854775808')" for v in values) + ")"
    every = longs(sorted({h for r in rows for h in r["shingles"]}))
    classes = defaultdict(list)
    for r in rows:
        classes[step(len(r["shingles"]))].append(r)
    found = (
        docs.select(F.col(key).alias("_key"), F.coalesce(F.col(text), F.lit("")).alias("_text"))
        .withColumn("_words", F.expr(_words("_text")))
        .withColumn("_all", F.expr(_shingles("_words")))
        # A text without any template's shingle contains no template: it has no windows.
        .withColumn("_shingles", F.expr(f"if(arrays_overlap(_all, {every}), _all, array())"))
    )
    parts = []
    for size, group in sorted(classes.items()):
        count = max(bands(len(r["shingles"])) for r in group)
        told = "array(" + ", ".join(f"named_struct('name', '{r['name']}', 'shingles', {longs(r['shingles'])}, 'signature', {longs(r['signature'][:count])})" for r in group) + ")"
        windows, signed, out = f"_w{size}", f"_v{size}", f"_m{size}"
        starts = f"sequence(0, greatest(size(_shingles) - 1, 0) div {size})"
        found = found.withColumn(
            windows,
            F.expr(f"filter(transform({starts}, i -> named_struct('word', i * {size}, 'held', array_distinct(slice(_shingles, i * {size} + 1, {2 * size})))), x -> arrays_overlap(x.held, {every}))"),
        ).withColumn(signed, F.expr(f"transform({windows}, x -> named_struct('word', x.word, 'held', x.held, 'signature', {_signature('x.held', count)}))"))
        agree = "exists(zip_with(x.signature, t.signature, (a, b) -> a = b), e -> e)"
        holds = f"size(array_intersect(t.shingles, x.held)) * 100 >= size(t.shingles) * {CONTAINMENT}"
        found = found.withColumn(
            out, F.expr(f"flatten(transform({signed}, x -> transform(filter({told}, t -> {agree} and {holds}), t -> named_struct('word', x.word, 'name', t.name))))")
        )
        parts.append(out)
    return fenced(found, F.col("_key").alias(key), F.expr(f"array_sort(concat({', '.join(parts)}))").alias("licenses"))
