"""License scans by sentence-rule recognition.

A text is cut into sentences; each is normalised and looked up among known
licence sentences, which gives a sequence of sentence identifiers. Ordered rules
are then matched against that sequence: the first rule that fits at a position
names the licence and consumes its identifiers, so a rule of several sentences
goes before the shorter ones it contains.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusflow.llm.common import ensure_parallel, text_or_empty

#: Known licence sentences (fixed values, from the published licence texts): identifier -> sentence
SENTENCES = {
    "mit-ref": "Released under the MIT License.",
    "mit-ref-2": "Licensed under the MIT License.",
    "mit-grant": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
                 "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation "
                 "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to "
                 "permit persons to whom the Software is furnished to do so, subject to the following conditions:",
    "mit-notice": "The above copyright notice and this permission notice shall be included in all copies or substantial portions of "
                  "the Software.",
    "as-is": "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE "
             "WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.",
    "apache-2-ref": "Licensed under the Apache License, Version 2.0.",
    "apache-2-header": "Licensed under the Apache License, Version 2.0 (the \"License\");",
    "apache-2-use": "you may not use this file except in compliance with the License.",
    "apache-2-copy": "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    "gpl-2-ref": "This work is licensed under the GNU General Public License, version 2.",
    "gpl-3-ref": "This work is licensed under the GNU General Public License, version 3.",
    "gpl-free": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
                "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later "
                "version.",
    "gpl-hope": "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied "
                "warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.",
    "lgpl-3-ref": "This work is licensed under the GNU Lesser General Public License, version 3.",
    "mpl-2-ref": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "bsd-redistribution": "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
                          "that the following conditions are met:",
    "bsd-source": "Redistributions of source code must retain the above copyright notice, this list of conditions and the following "
                  "disclaimer.",
    "bsd-binary": "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the "
                  "following disclaimer in the documentation and/or other materials provided with the distribution.",
    "bsd-names": "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products "
                 "derived from this software without specific prior written permission.",
    "mit-project": "This project is licensed under the MIT License - see the LICENSE file for details.",
    "mit-project-md": "This project is licensed under the MIT License - see the LICENSE.md file for details.",
    "isc": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
           "provided that the above copyright notice and this permission notice appear in all copies.",
    "apache-2-law": "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on "
                    "an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
    "apache-2-title": "Apache License Version 2.0, January 2004",
    "gpl-2-later-ref": "This work is licensed under the GNU General Public License, version 2 or later.",
    "gpl-3-later-ref": "This work is licensed under the GNU General Public License, version 3 or later.",
    "gpl-2-free": "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public "
                  "License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later "
                  "version.",
    "agpl-free": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General "
                 "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any "
                 "later version.",
    "lgpl-3-free": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General "
                   "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) "
                   "any later version.",
    "lgpl-2-free": "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General "
                   "Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) "
                   "any later version.",
    "unlicense": "This is free and unencumbered software released into the public domain.",
    "cc-by-4": "Licensed under CC BY 4.0.",
    "cc-by-sa-4": "Licensed under CC BY-SA 4.0.",
    "cc-by-nc-4": "Licensed under CC BY-NC 4.0.",
    "cc-by-nd-4": "Licensed under CC BY-ND 4.0.",
    "cc-by-nc-sa-4": "Licensed under CC BY-NC-SA 4.0.",
    "cc0": "To the extent possible under law, the author has waived all copyright and related rights to this work.",
    "public-domain": "This work is in the public domain.",
    "reserved": "All rights reserved.",
}

#: Ordered rules: identifier sequence -> licence
RULES = (
    (("mit-grant", "mit-notice", "as-is"), "MIT"),
    (("mit-grant", "mit-notice"), "MIT"),
    (("mit-ref",), "MIT"),
    (("mit-ref-2",), "MIT"),
    (("apache-2-header", "apache-2-use", "apache-2-copy", "apache-2-law"), "Apache-2.0"),
    (("apache-2-header", "apache-2-use", "apache-2-copy"), "Apache-2.0"),
    (("apache-2-header",), "Apache-2.0"),
    (("apache-2-ref",), "Apache-2.0"),
    (("gpl-free", "gpl-hope"), "GPL-3.0-or-later"),
    (("gpl-free",), "GPL-3.0-or-later"),
    (("gpl-3-ref",), "GPL-3.0"),
    (("gpl-2-ref",), "GPL-2.0"),
    (("lgpl-3-ref",), "LGPL-3.0"),
    (("mpl-2-ref",), "MPL-2.0"),
    (("bsd-redistribution", "bsd-source", "bsd-binary", "bsd-names"), "BSD-3-Clause"),
    (("bsd-redistribution", "bsd-source", "bsd-binary"), "BSD-2-Clause"),
    (("mit-project",), "MIT"),
    (("mit-project-md",), "MIT"),
    (("isc", "as-is"), "ISC"),
    (("isc",), "ISC"),
    (("apache-2-title",), "Apache-2.0"),
    (("gpl-2-later-ref",), "GPL-2.0-or-later"),
    (("gpl-3-later-ref",), "GPL-3.0-or-later"),
    (("gpl-2-free", "gpl-hope"), "GPL-2.0-or-later"),
    (("gpl-2-free",), "GPL-2.0-or-later"),
    (("agpl-free", "gpl-hope"), "AGPL-3.0-or-later"),
    (("agpl-free",), "AGPL-3.0-or-later"),
    (("lgpl-3-free", "gpl-hope"), "LGPL-3.0-or-later"),
    (("lgpl-3-free",), "LGPL-3.0-or-later"),
    (("lgpl-2-free",), "LGPL-2.1-or-later"),
    (("unlicense",), "Unlicense"),
    (("cc-by-4",), "CC-BY-4.0"),
    (("cc-by-sa-4",), "CC-BY-SA-4.0"),
    (("cc-by-nc-4",), "CC-BY-NC-4.0"),
    (("cc-by-nd-4",), "CC-BY-ND-4.0"),
    (("cc-by-nc-sa-4",), "CC-BY-NC-SA-4.0"),
    (("cc0",), "CC0-1.0"),
    (("public-domain",), "public-domain"),
    (("reserved",), "all-rights-reserved"),
)

#: SPDX identifiers (fixed values) that a line ``SPDX-License-Identifier: <id>`` may name
SPDX = ("MIT", "Apache-2.0", "GPL-2.0-only", "GPL-2.0-or-later", "GPL-3.0-only", "GPL-3.0-or-later", "LGPL-2.1-only", "LGPL-2.1-or-later",
        "LGPL-3.0-only", "LGPL-3.0-or-later", "AGPL-3.0-only", "AGPL-3.0-or-later", "BSD-2-Clause", "BSD-3-Clause", "ISC", "MPL-2.0",
        "CC0-1.0", "CC-BY-4.0", "CC-BY-SA-4.0", "Unlicense")
SENTENCES |= {f"spdx-{x}": f"SPDX-License-Identifier: {x}" for x in SPDX}
RULES += tuple(((f"spdx-{x}",), x) for x in SPDX)

#: every known sentence has one of these words, so a text without any has no licence sentence
TRIGGERS = r"(?i)licen|permission|copyright|warrant|redistribut|public domain|rights reserved|free software"

_BREAK = re.compile(r"(?<=[.;:!?])\s+|\s*\n\s*")
_NOISE = re.compile(r"[^a-z0-9]+")


def normalise(sentence: str) -> str:
    """Lower case, with everything but letters and digits as one space."""
    return _NOISE.sub(" ", sentence.lower()).strip()


def fragments(text: str) -> list[str]:
    """Normalised pieces of a text between sentence ends and line ends, without empty ones."""
    return [f for f in map(normalise, _BREAK.split(text)) if f]


class Scanner:
    """``scan(text)``: licence-sentence identifiers in order, and the licences the rules name."""

    def __init__(self, sentences: dict[str, str] | None = None, rules=RULES) -> None:
        # a known sentence may itself break into fragments; they are looked up joined
        self.known = {" ".join(fragments(s)): i for i, s in (sentences or SENTENCES).items()}
        self.starts = {k.split(" ", 1)[0] for k in self.known}
        self.longest = max(map(len, self.known))
        self.rules = rules

    def sentences(self, text: str) -> list[str]:
        parts, out, i = fragments(text), [], 0
        while i < len(parts):
            found, step = None, 1
            if parts[i].split(" ", 1)[0] in self.starts:
                joined = ""
                for k in range(i, len(parts)):  # however many lines a sentence is wrapped over
                    joined = f"{joined} {parts[k]}" if joined else parts[k]
                    if len(joined) > self.longest:
                        break
                    if joined in self.known:  # the longest known sentence that begins here
                        found, step = self.known[joined], k - i + 1
            if found:
                out.append(found)
            i += step
        return out

    def licenses(self, ids: list[str]) -> list[str]:
        out, i = [], 0
        while i < len(ids):
            for rule, name in self.rules:
                if tuple(ids[i:i + len(rule)]) == rule:
                    out.append(name)
                    i += len(rule)
                    break
            else:
                i += 1
        return out


def scan(docs: DataFrame, sentences: dict[str, str] | None = None, rules=RULES, triggers: str | None = TRIGGERS) -> DataFrame:
    """``doc_id, sentence_ids, licenses, license`` per row.

    ``sentence_ids`` and ``licenses`` keep order and repetitions; ``license`` joins
    the distinct licences, sorted, with `` AND `` (null if there is none). Null and
    empty texts have none. ``triggers`` only skips texts that cannot match; give
    None with sentences of your own that lack those words. Repeated rows are
    scanned alike; other columns are ignored; an empty table gives an empty
    result.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty(F.col("text")).alias("text"))
    if triggers:
        rows = rows.withColumn("text", F.when(F.col("text").rlike(triggers), F.col("text")).otherwise(""))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(sentences, rules)
        for batch in batches:
            ids = [scanner.sentences(t.as_py()) for t in batch.column("text")]
            named = [scanner.licenses(x) for x in ids]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(ids, pa.list_(pa.string())), pa.array(named, pa.list_(pa.string())),
                 pa.array([" AND ".join(sorted(set(x))) or None for x in named], pa.string())],
                names=["doc_id", "sentence_ids", "licenses", "license"])

    return ensure_parallel(rows).mapInArrow(run, "doc_id long, sentence_ids array<string>, licenses array<string>, license string")
