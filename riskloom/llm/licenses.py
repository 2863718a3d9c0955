"""License scans: TF-IDF cosine of headers and licence files to templates, inherited from the nearest directory.

DataFrame functions only.
"""

from __future__ import annotations

import json
import math
import re
from collections import Counter
from collections.abc import Iterable
from pathlib import Path

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.functions.rows import compute_once
from riskloom.llm.common import text_or_empty
from riskloom.session import materialize

THRESHOLD = 0.75

# fixed values: public licence notices
TEMPLATES = {
    "MIT": ["Released under the MIT License.", "Licensed under the MIT license.", "SPDX-License-Identifier: MIT"],
    "Apache-2.0": ["Licensed under the Apache License, Version 2.0.", "SPDX-License-Identifier: Apache-2.0"],
    "GPL-3.0": ["This work is licensed under the GNU General Public License, version 3.", "SPDX-License-Identifier: GPL-3.0-only"],
    "GPL-2.0": ["This work is licensed under the GNU General Public License, version 2.", "SPDX-License-Identifier: GPL-2.0-only"],
    "BSD-3-Clause": ["Licensed under the BSD 3-Clause License.", "SPDX-License-Identifier: BSD-3-Clause"],
    "MPL-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."],
    "CC-BY-4.0": ["Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."],
    "CC-BY-SA-4.0": ["Licensed under CC BY-SA 4.0."],
    "CC-BY-NC-4.0": ["Licensed under CC BY-NC 4.0."],
    "CC0-1.0": ["Licensed under CC0 1.0."],
}

# first paragraphs of the notices that the licences ask to put into files
HEADERS = {
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with "
        "the License. You may obtain a copy of the License at"],
    "GPL-2.0": [
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License "
        "as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."],
    "GPL-3.0": [
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License "
        "as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."],
    "AGPL-3.0": [
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."],
    "LGPL-2.1": [
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public "
        "License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version."],
    "MPL-2.0": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
        "distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."],
    "MIT": [
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation "
        "files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, "
        "modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the "
        "Software is furnished to do so, subject to the following conditions:"],
    "ISC": [
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
        "provided that the above copyright notice and this permission notice appear in all copies."],
    "BSD-3-Clause": [
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products "
        "derived from this software without specific prior written permission."],
}

# words that any prose has: they only decide which lines are looked at, never a score
COMMON = frozenset((
    "a all an and any are as at be but by can do for free from if in is it its may name names no not obtain of on one or other "
    "out part source that the these this to under use used version will with without work you").split())
# end of fixed values

PARTS = "array<struct<value double, terms array<string>>>"
TERM = "[a-z0-9]+(?:\\.[0-9]+)*"
GAP = "\n[^a-z0-9]*\n"  # between two blocks: lines without any term


def full_texts() -> dict[str, list[str]]:
    """The public licence texts of the folder `license_texts`, one file per licence."""
    return {p.stem: [p.read_text(encoding="utf-8")] for p in sorted((Path(__file__).parent / "license_texts").glob("*.txt"))}


def blocks_of(templates: dict[str, list[str]], headers: dict[str, list[str]]) -> dict[str, list[str]]:
    """What blocks are held against: the notices, which may run over two lines, and the headers."""
    return {name: [*templates.get(name, []), *headers.get(name, [])] for name in {**templates, **headers}}


def _terms(text: str) -> Counter:
    return Counter(re.findall(TERM, text.lower()))


def template_weights(templates: dict[str, list[str]]) -> tuple[list[tuple[str, int, str, float]], dict[str, float], float]:
    """(licence, notice, term, unit-length weight) rows, each term's squared idf, and the idf of a term that no notice has.

    idf is 1 + ln((1 + notices) / (1 + notices with the term)). Frequencies inside a notice are counted once.
    """
    notices = [(name, i, set(_terms(t))) for name, texts in templates.items() for i, t in enumerate(texts)]
    seen = Counter(w for _, _, words in notices for w in words)
    idf = {w: 1 + math.log((1 + len(notices)) / (1 + n)) for w, n in seen.items()}
    rows = []
    for name, i, words in notices:
        norm = math.sqrt(sum(idf[w] ** 2 for w in words))
        rows += [(name, i, w, round(idf[w] / norm, 9)) for w in sorted(words)]
    return rows, {w: round(v * v, 9) for w, v in sorted(idf.items())}, 1 + math.log(1 + len(notices))


def _notices(rows: list[tuple[str, int, str, float]]) -> dict[tuple[str, int], dict[str, float]]:
    out: dict[tuple[str, int], dict[str, float]] = {}
    for name, i, word, weight in rows:
        out.setdefault((name, i), {})[word] = weight
    return out


def telling_terms(rows: list[tuple[str, int, str, float]], threshold: float) -> list[str]:
    """Terms of which every unit over the threshold must have one: a notice's other terms together stay below it.

    Words that any prose has are taken last, long ones first.
    """
    out: set[str] = set()
    for weights in _notices(rows).values():
        rest = sum(w * w for w in weights.values())
        for term in sorted(weights, key=lambda t: (t in COMMON, -len(t), t)):
            if rest < (threshold * 0.999) ** 2:
                break
            out.add(term)
            rest -= weights[term] ** 2
    return sorted(out)


def least_terms(rows: list[tuple[str, int, str, float]], threshold: float) -> int:
    """How many terms of the templates every unit over the threshold must have, whichever template it meets."""
    counts = []
    for weights in _notices(rows).values():
        mass, n = 0.0, 0
        for w in sorted(weights.values(), reverse=True):
            if mass >= (threshold * 0.999) ** 2:
                break
            mass, n = mass + w * w, n + 1
        counts.append(n)
    return min(counts, default=0)


def _any_of(terms: Iterable[str]) -> str:
    """A pattern for one of the terms as a whole word; terms are grouped by their first letter."""
    by_first: dict[str, list[str]] = {}
    for t in sorted(terms):
        by_first.setdefault(t[0], []).append(re.escape(t[1:]))
    return "(?<![a-z0-9])(?:" + "|".join(f"{c}(?:{'|'.join(rest)})" for c, rest in by_first.items()) + ")(?![a-z0-9])"


def _equal(values: dict[str, float]) -> list[dict]:
    """The terms of each value, so that terms of one value are counted together."""
    out: dict[float, list[str]] = {}
    for term, value in values.items():
        out.setdefault(value, []).append(term)
    return [{"value": v, "terms": terms} for v, terms in out.items()]


def _constant(value, schema: str) -> Column:
    """A nested Python value as one constant of the plan."""
    return F.from_json(F.lit(json.dumps(value)), schema)


def _sum(words: Column, parts: Column) -> Column:
    """The sum of the values of those distinct words that have one (`_equal`)."""
    return F.aggregate(parts, F.lit(0.0), lambda total, p: total + F.size(F.array_intersect(words, p["terms"])) * p["value"])


def unit_scores(units: DataFrame, templates: dict[str, list[str]], threshold: float) -> DataFrame:
    """(file_id, license, score) of every unit (file_id, lower-case body) and template at or over the threshold.

    A unit's length in the cosine takes in the terms that no template knows. A unit is scored in its row against all
    templates, whose terms are fixed. Only units with as many known terms as the threshold needs are scored.
    """
    rows, squares, unseen = template_weights(templates)
    terms = units.select("file_id", F.array_distinct(F.regexp_extract_all("body", F.lit(TERM), F.lit(0))).alias("terms"))
    known = terms.select("file_id", F.array_intersect("terms", F.lit(list(squares))).alias("known"), F.size("terms").alias("n")).where(
        F.size("known") >= least_terms(rows, threshold))
    values = _constant(_equal(squares), PARTS)
    norm = F.sqrt(_sum(F.col("known"), values) + (F.col("n") - F.size("known")) * F.lit(round(unseen * unseen, 9)))
    all_of = [{"license": name, "parts": _equal({w: math.sqrt(squares[w]) * v for w, v in weights.items()})}
              for (name, _), weights in _notices(rows).items()]
    scores = F.transform(
        _constant(all_of, f"array<struct<license string, parts {PARTS}>>"),
        lambda t: F.struct(t["license"].alias("license"), _sum(F.col("known"), t["parts"]).alias("dot")))
    scored = compute_once(known, norm=norm).select("file_id", "norm", F.inline(scores))
    return scored.select("file_id", "license", F.round(F.col("dot") / F.col("norm"), 6).alias("score")).where(F.col("score") >= threshold)


def notice_scores(
    files: DataFrame, templates: dict[str, list[str]], headers: dict[str, list[str]], texts: dict[str, list[str]], threshold: float,
) -> DataFrame:
    """(file_id, license, score): the best template of each file (file_id, text, named), over its whole text.

    Every line is held against the notices, every block (lines between lines without terms) against notices and headers,
    and the whole of a licence file (`named`) against the licence texts. Each of the three has weights of its own.
    Lines and blocks count if they have one of the terms without which the threshold is out of reach; only texts that
    have one are cut at all. Only scores over the threshold are shuffled. Scores are rounded to 6 places; ties go to the
    first licence by name.
    """
    low = files.select("file_id", "named", F.lower("text").alias("low"))
    parts = []
    for pattern, known in (("\n", templates), (GAP, blocks_of(templates, headers))):
        if any(known.values()):
            telling = _any_of(telling_terms(template_weights(known)[0], threshold))
            cut = low.where(F.col("low").rlike(telling)).select("file_id", F.explode(F.split("low", pattern)).alias("body"))
            parts.append(unit_scores(cut.where(F.col("body").rlike(telling)), known, threshold))
    if any(texts.values()):
        parts.append(unit_scores(low.where("named").select("file_id", F.col("low").alias("body")), texts, threshold))
    scored = parts[0]
    for part in parts[1:]:
        scored = scored.unionByName(part)
    best = scored.groupBy("file_id").agg(F.min(F.struct((-F.col("score")).alias("less"), "license")).alias("b"))
    return best.select("file_id", F.col("b.license").alias("license"), (-F.col("b.less")).alias("score"))


def _directory(path: Column) -> Column:
    return F.regexp_replace(path, "/?[^/]*$", "")


def license_scan(
    files: DataFrame, templates: dict[str, list[str]] | None = None, threshold: float = THRESHOLD,
    headers: dict[str, list[str]] | None = None, texts: dict[str, list[str]] | None = None,
) -> DataFrame:
    """One row per file (file_id, path, text): file_id, path, license, score, origin, license_dir.

    A file with a notice or header of its own, or a licence file with a licence's text, has origin `header`; see
    `notice_scores`. Others inherit from the nearest directory on their path with a
    licence file: a file named LICENSE, LICENCE, COPYING or NOTICE (with any suffix) whose text matches; origin
    `directory`, and the score is that of the licence file. The best licence file of a directory counts, ties go to the
    first licence by name. The rest has origin `none` and null licence.

    Only scores leave the scan. Directories, not files, are expanded into their ancestors; the table
    of directories is written before files join it, so a directory with most files is split. Null text is empty and
    matches nothing; a null path has no directory and inherits nothing. Repeated rows and ids are reported one by one,
    rows of one id sharing its best notice. A very long text is scored whole, its terms held in memory. An empty table gives no rows. Other columns are not read.
    """
    templates = TEMPLATES if templates is None else templates
    headers = HEADERS if headers is None else headers
    texts = full_texts() if texts is None else texts
    named = F.upper(F.regexp_extract("path", "([^/]*)$", 1)).rlike("^(LICEN[CS]E|COPYING|NOTICE)([^A-Z].*)?$")
    files = files.select("file_id", F.col("path").cast("string").alias("path"), text_or_empty(F.col("text")).alias("text"))
    files = files.withColumn("named", F.coalesce(named, F.lit(False)))
    own = materialize(notice_scores(files, templates, headers, texts, threshold), "notices")
    place = files.select("file_id", "path", _directory(F.col("path")).alias("dir"), "named")
    mine = own.select(F.col("file_id").alias("_f"), "license", "score")
    holders = place.where("named").join(mine, F.col("file_id") == F.col("_f")).groupBy("dir").agg(
        F.min(F.struct((-F.col("score")).alias("less"), "license")).alias("b")).select(
        F.col("dir").alias("license_dir"), F.col("b.license").alias("dir_license"), (-F.col("b.less")).alias("dir_score"))
    parts = F.split("dir", "/")
    ancestors = F.transform(F.sequence(F.lit(0), F.size(parts)), lambda n: F.array_join(F.slice(parts, 1, n), "/"))
    folders = place.select("dir").where("dir is not null").distinct().select("dir", F.explode(F.array_distinct(ancestors)).alias("up"))
    nearest = folders.join(holders, F.col("up") == F.col("license_dir")).groupBy("dir").agg(
        F.max_by(F.struct("license_dir", "dir_license", "dir_score"), F.length("up")).alias("n"))
    nearest = materialize(nearest.select(F.col("dir").alias("_d"), "n.license_dir", "n.dir_license", "n.dir_score"), "directories")
    joined = place.join(mine, F.col("file_id") == F.col("_f"), "left").join(nearest, F.col("dir") == F.col("_d"), "left")
    has = F.col("license").isNotNull()
    return joined.select(
        "file_id", "path", F.when(has, F.col("license")).otherwise(F.col("dir_license")).alias("license"),
        F.when(has, F.col("score")).otherwise(F.col("dir_score")).alias("score"),
        F.when(has, "header").when(F.col("dir_license").isNotNull(), "directory").otherwise("none").alias("origin"),
        F.when(~has, F.col("license_dir")).alias("license_dir"))
