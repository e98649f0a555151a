"""License of each file: similarity to templates, then the nearest licensed folder.

A file's header is its run of lines that name a licence or a right: lines with
one of the ``CUES``. Headers, and the whole text of licence files (files named
like LICENSE or COPYING), become sparse TF-IDF vectors over the terms of the
templates and are compared with each template by cosine. What matches none of
these one-line notices is compared with whole licence texts and the headers of
source files as well: a licence file as a whole, any other file by its header
and by each of its lines, without the lines that name a holder of copyright. A
licence found so goes before a reservation of rights. A licence file decides
for its folder; a file without a licence of its own inherits that of its nearest
ancestor folder that has one, found by a join on the path's ancestors.

Edge cases: a missing or empty text matches nothing and may still inherit; a
missing path has no folder and inherits nothing; ties between templates go to
the first name, between licence files of one folder to the smallest path; equal
rows get equal results; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from pathlib import Path

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketloom.llm.words import LOWER, UPPER
from marketloom.session import materialize

#: Notices of common licences, as they stand in files.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in "
                  "compliance with the License. Unless required by applicable law or agreed to in writing, software "
                  "distributed under the License is distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS "
                  "OF ANY KIND, either express or implied.",
    "Apache-2.0-short": "Licensed under the Apache License, Version 2.0.",
    "BSD-3-Clause": "Redistribution and use in source and binary forms, with or without modification, are permitted "
                    "provided that the following conditions are met. BSD License.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "MIT": "Released under the MIT License.",
    "MIT-long": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
                "associated documentation files, to deal in the Software without restriction. MIT License.",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "Proprietary": "All rights reserved.",
}
#: Whole licences, one file each, named by the licence.
TEXTS = Path(__file__).with_name("license_texts")
_GNU = ("This program is free software; you can redistribute it and/or modify\nit under the terms of the GNU {0} as published by\n"
        "the Free Software Foundation, either version {1} of the License, or\n(at your option) any later version.\n\n"
        "This program is distributed in the hope that it will be useful,\nbut WITHOUT ANY WARRANTY; without even the implied warranty of\n"
        "MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the\nGNU {0} for more details.\n\n"
        "You should have received a copy of the GNU {0}\nalong with this program. If not, see <https://www.gnu.org/licenses/>.")
#: Headers that licences ask source files to carry.
SOURCE_HEADERS = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0 (the License);\nyou may not use this file except in compliance "
                  "with the License.\nYou may obtain a copy of the License at\n\nhttp://www.apache.org/licenses/LICENSE-2.0\n\n"
                  "Unless required by applicable law or agreed to in writing, software\ndistributed under the License is distributed "
                  "on an AS IS BASIS,\nWITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.\n"
                  "See the License for the specific language governing permissions and\nlimitations under the License.",
    "GPL-2.0": _GNU.format("General Public License", "2"),
    "GPL-3.0": _GNU.format("General Public License", "3"),
    "LGPL-2.1": _GNU.format("Lesser General Public License", "2.1"),
    "LGPL-3.0": _GNU.format("Lesser General Public License", "3"),
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public\nLicense, v. 2.0. If a copy of the MPL was not "
               "distributed with this\nfile, You can obtain one at https://mozilla.org/MPL/2.0/.",
}
#: Between a template's name and its form.
FORM = "/"
#: Reserves rights and grants none.
NO_GRANT = "Proprietary"
HOLDER = r"^[^a-z]*copyright\s*(\(c\)|©|[0-9])"
CUES = r"licen[sc]e|all rights reserved|redistribution|permission is hereby granted|copyright"
LICENSE_FILE = r"(^|/)(licen[sc]e|copying|notice)[^/]*$"
MIN_COSINE = 0.6
#: Cosines are rounded to so many places, so that engines agree on ties.
PLACES = 6


def lowered(c: Column) -> Column:
    return F.translate(c, UPPER, LOWER)


def terms(c: Column) -> Column:
    """Runs of ASCII letters, digits and dots between them, in lower case."""
    return F.regexp_extract_all(c, F.lit(r"[a-z0-9]+(?:\.[0-9]+)*"), F.lit(0))


def header(text: Column) -> Column:
    """Lines with a cue, joined; of the whole text."""
    lines = F.filter(F.split(lowered(F.coalesce(text, F.lit(""))), "\n"), lambda x: x.rlike(CUES))
    return F.array_join(lines, "\n")


def whole_templates() -> dict[str, str]:
    """Name and form of each notice, source header, whole text and what ``header`` leaves of the longer ones."""
    cue = re.compile(CUES)
    longer = {f"{k}{FORM}source": v for k, v in SOURCE_HEADERS.items()}
    longer |= {f"{p.stem}{FORM}text": p.read_text(encoding="utf-8") for p in TEXTS.glob("*.txt")}
    cues = {f"{k}-cues": "\n".join(x for x in v.lower().split("\n") if cue.search(x)) for k, v in longer.items()}
    return {**TEMPLATES, **longer, **cues}


def notices(rest: DataFrame) -> DataFrame:
    """(fid, header) with one row per notice to compare; ``fid`` is the file's and the notice's number."""
    lines = F.filter(F.split("header", "\n"), lambda x: ~x.rlike(HOLDER))
    whole = F.array(F.array_join(lines, "\n"))
    return rest.select("fid", F.posexplode(F.when(F.col("is_license"), whole).otherwise(F.concat(whole, lines)))).select(
        F.struct("fid", "pos").alias("fid"), F.col("col").alias("header"))


def whole_matches(rest: DataFrame, min_cosine: float) -> DataFrame:
    """(fid, whole, whole_cosine): the best licence of a file's notices."""
    found = matches(notices(rest), whole_templates(), min_cosine).select(
        "fid.fid", F.substring_index("template", FORM, 1).alias("whole"), F.col("cosine").alias("whole_cosine"))
    order = F.struct((F.col("whole") == NO_GRANT).alias("no_grant"), (-F.col("whole_cosine")).alias("o"), "whole")
    return found.groupBy("fid").agg(F.min(order).alias("best")).select(
        "fid", F.col("best.whole").alias("whole"), (-F.col("best.o")).alias("whole_cosine"))


def template_vectors(spark, templates: dict[str, str]) -> DataFrame:
    """(template, term, weight): unit TF-IDF vectors, idf over the templates."""
    rows = F.array(*[F.struct(F.lit(k).alias("template"), F.lit(v).alias("text")) for k, v in sorted(templates.items())])
    counted = (
        spark.range(1).select(F.inline(rows)).select("template", F.explode(terms(lowered(F.col("text")))).alias("term"))
        .groupBy("template", "term").agg(F.count(F.lit(1)).alias("tf"))
    )
    with_idf = counted.withColumn("idf", F.log(F.lit(1.0 + len(templates)) / F.count(F.lit(1)).over(Window.partitionBy("term"))))
    weight = F.col("tf") * F.col("idf")
    norm = F.sqrt(F.sum(weight * weight).over(Window.partitionBy("template")))
    return with_idf.select("template", "term", "idf", (weight / norm).alias("weight"))


def matches(files: DataFrame, templates: dict[str, str], min_cosine: float) -> DataFrame:
    """(fid, template, cosine): the best template of each header that is similar enough.

    Terms outside the templates enter the norm with the largest idf. Only
    headers with a term of some template are compared.
    """
    by_term = template_vectors(files.sparkSession, templates).groupBy("term").agg(
        F.max("idf").alias("idf"), F.collect_list(F.struct("template", "weight")).alias("in"))
    counted = (
        files.where("header <> ''").select("fid", F.explode(terms(F.col("header"))).alias("term"))
        .groupBy("fid", "term").agg(F.count(F.lit(1)).alias("tf"))
    )
    weighted = counted.join(by_term, "term", "left").select(
        "fid", (F.col("tf") * F.coalesce("idf", F.log(F.lit(1.0 + len(templates))))).alias("w"), "in")
    norms = weighted.groupBy("fid").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
    dots = weighted.select("fid", "w", F.inline("in")).groupBy("fid", "template").agg(
        F.sum(F.col("w") * F.col("weight")).alias("dot"))
    cosine = F.round(F.col("dot") / F.col("norm"), PLACES)
    return (
        dots.join(norms, "fid").select("fid", "template", cosine.alias("cosine")).where(F.col("cosine") >= min_cosine)
        .groupBy("fid").agg(F.min(F.struct((-F.col("cosine")).alias("o"), "template")).alias("best"))
        .select("fid", F.col("best.template").alias("template"), (-F.col("best.o")).alias("cosine"))
    )


def folder(path: Column) -> Column:
    """The path up to its last slash; empty at the top."""
    return F.regexp_extract(path, "^(.*)/[^/]*$", 1)


def ancestors(path: Column) -> Column:
    """(folder, depth) of all folders above a path, the top folder '' included."""
    parts = F.split(path, "/")
    return F.transform(F.sequence(F.lit(0), F.size(parts) - 1), lambda d: F.struct(
        F.array_join(F.slice(parts, 1, d), "/").alias("folder"), d.alias("depth")))


def scanned(files: DataFrame, templates: dict[str, str] = TEMPLATES, min_cosine: float = MIN_COSINE) -> DataFrame:
    """(fid, path, own, cosine, license, origin) of files with fid, path and text.

    ``origin`` is 'own', 'inherited' or null. Rows that share
    a fid are read as one file.
    """
    is_license = F.coalesce(lowered(F.col("path")).rlike(LICENSE_FILE), F.lit(False))
    read = materialize(files.select("fid", "path", is_license.alias("is_license"), F.when(
        is_license, lowered(F.coalesce("text", F.lit("")))).otherwise(header(F.col("text"))).alias("header")), "license-headers")
    first = materialize(read.join(matches(read, templates, min_cosine), "fid", "left").select(
        "fid", "path", "is_license", "template", "cosine",
        F.when(F.col("template").isNull(), F.col("header")).alias("header")), "license-notices")
    whole = whole_matches(first.where("header <> ''"), min_cosine)
    own = materialize(first.join(whole, "fid", "left").select(
        "fid", "path", "is_license", F.coalesce("template", "whole").alias("template"),
        F.coalesce("cosine", "whole_cosine").alias("cosine")), "license-matches")
    licensed = own.where("is_license AND template IS NOT NULL").groupBy(folder(F.col("path")).alias("folder")).agg(
        F.min(F.struct("path", "template")).alias("l")).select("folder", F.col("l.template").alias("folder_template"))
    # Folders are few next to files: ancestors are resolved per folder, then joined back.
    nearest = materialize(
        own.where("path IS NOT NULL").select(folder(F.col("path")).alias("of")).distinct()
        .select("of", F.inline(ancestors(F.concat("of", F.lit("/x"))))).join(licensed, "folder")
        .groupBy("of").agg(F.max(F.struct("depth", "folder_template")).alias("n")).select("of", F.col("n.folder_template").alias("near")),
        "license-folders")
    return own.join(nearest, folder(F.col("path")) == F.col("of"), "left").select(
        "fid", "path", F.col("template").alias("own"), "cosine", F.coalesce("template", "near").alias("license"),
        F.when(F.col("template").isNotNull(), "own").when(F.col("near").isNotNull(), "inherited").alias("origin"))
