"""Licence detection by sentences: known sentences get identifiers, runs of identifiers are held against ordered rules.

DataFrame functions only.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import ascii_lower

#: Licence sentences as normalise() gives them. The identifier is the key.
SENTENCES = {
    "mit-notice": "released under the mit license",
    "mit-notice-2": "this project is licensed under the mit license",
    "mit-grant": "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions",
    "mit-keep": "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software",
    "mit-as-is": "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement",
    "apache-notice": "licensed under the apache license version 2 0",
    "apache-notice-long": "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license",
    "apache-copy": "you may obtain a copy of the license at",
    "apache-url": "http www apache org licenses license 2 0",
    "apache-as-is": "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied",
    "gpl3-notice": "this work is licensed under the gnu general public license version 3",
    "gpl-free": "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version",
    "gpl-hope": "this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose",
    "gpl-details": "see the gnu general public license for more details",
    "cc-by-nc-notice": "licensed under cc by nc 4 0",
    "cc-by-notice": "licensed under cc by 4 0",
    "cc-by-sa-notice": "licensed under cc by sa 4 0",
    "bsd-grant": "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",
    "bsd-source": "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer",
    "bsd-binary": "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution",
    "bsd-names": "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission",
    "rights-reserved": "all rights reserved",
    "isc-grant": "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies",
    "isc-as-is": "the software is provided as is and the author disclaims all warranties with regard to this software including all implied warranties of merchantability and fitness",
    "mpl-notice": "this source code form is subject to the terms of the mozilla public license v 2 0",
    "mpl-url": "if a copy of the mpl was not distributed with this file you can obtain one at http mozilla org mpl 2 0",
    "mpl-url-2": "if a copy of the mpl was not distributed with this file you can obtain one at https mozilla org mpl 2 0",
    "gpl2-free": "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version",
    "lgpl-free": "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 2 1 of the license or at your option any later version",
    "lgpl-hope": "this library is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose",
    "lgpl-details": "see the gnu lesser general public license for more details",
    "agpl-free": "this program is free software you can redistribute it and or modify it under the terms of the gnu affero general public license as published by the free software foundation either version 3 of the license or at your option any later version",
    "agpl-details": "see the gnu affero general public license for more details",
    "bsl-title": "boost software license version 1 0",
    "bsl-header": "distributed under the boost software license version 1 0",
    "cc0-title": "cc0 1 0 universal",
    "cc0-waiver": "to the extent possible under law the author s have dedicated all copyright and related and neighboring rights to this software to the public domain worldwide",
    "unlicense-free": "this is free and unencumbered software released into the public domain",
    "unlicense-anyone": "anyone is free to copy modify publish use compile sell or distribute this software either in source code form or as a compiled binary for any purpose commercial or non commercial and by any means",
    "zlib-as-is": "this software is provided as is without any express or implied warranty",
    "zlib-grant": "permission is granted to anyone to use this software for any purpose including commercial applications and to alter it and redistribute it freely subject to the following restrictions",
    "zlib-origin": "the origin of this software must not be misrepresented you must not claim that you wrote the original software",
    "zlib-altered": "altered source versions must be plainly marked as such and must not be misrepresented as being the original software",
    "zlib-keep": "this notice may not be removed or altered from any source distribution",
    "apache-title": "apache license version 2 0 january 2004",
    "apache-terms": "terms and conditions for use reproduction and distribution",
    "apache-copyright": "subject to the terms and conditions of this license each contributor hereby grants to you a perpetual worldwide non exclusive no charge royalty free irrevocable copyright license to reproduce prepare derivative works of publicly display publicly perform sublicense and distribute the work and such derivative works in source or object form",
}

#: Identifiers in lines that name a licence by its SPDX short form.
SPDX = [
    "MIT", "Apache-2.0", "GPL-2.0-only", "GPL-2.0-or-later", "GPL-3.0-only", "GPL-3.0-or-later", "LGPL-2.1-only", "LGPL-2.1-or-later", "LGPL-3.0-only",
    "LGPL-3.0-or-later", "AGPL-3.0-only", "AGPL-3.0-or-later", "BSD-2-Clause", "BSD-3-Clause", "ISC", "MPL-2.0", "BSL-1.0", "CC0-1.0", "Unlicense", "Zlib",
    "CC-BY-4.0", "CC-BY-SA-4.0", "CC-BY-NC-4.0",
]
SENTENCES |= {f"spdx-{x}": "spdx license identifier " + re.sub("[^0-9a-z]+", " ", x.lower()) for x in SPDX}

#: Rule -> (licence, identifiers that follow one another). These grant something.
GRANTS = {
    "mit-by-notice": ("MIT", ["mit-notice"]),
    "mit-by-project-notice": ("MIT", ["mit-notice-2"]),
    "mit-text": ("MIT", ["mit-grant", "mit-keep", "mit-as-is"]),
    "apache-by-notice": ("Apache-2.0", ["apache-notice"]),
    "apache-header": ("Apache-2.0", ["apache-notice-long", "apache-copy", "apache-url", "apache-as-is"]),
    "gpl-3-by-notice": ("GPL-3.0-only", ["gpl3-notice"]),
    "gpl-3-or-later-header": ("GPL-3.0-or-later", ["gpl-free", "gpl-hope", "gpl-details"]),
    "cc-by-nc-by-notice": ("CC-BY-NC-4.0", ["cc-by-nc-notice"]),
    "cc-by-by-notice": ("CC-BY-4.0", ["cc-by-notice"]),
    "cc-by-sa-by-notice": ("CC-BY-SA-4.0", ["cc-by-sa-notice"]),
    "bsd-3-text": ("BSD-3-Clause", ["bsd-grant", "bsd-source", "bsd-binary", "bsd-names"]),
    "bsd-2-text": ("BSD-2-Clause", ["bsd-grant", "bsd-source", "bsd-binary"]),
    "isc-text": ("ISC", ["isc-grant", "isc-as-is"]),
    "mpl-2-header": ("MPL-2.0", ["mpl-notice", "mpl-url"]),
    "mpl-2-header-https": ("MPL-2.0", ["mpl-notice", "mpl-url-2"]),
    "gpl-2-or-later-header": ("GPL-2.0-or-later", ["gpl2-free", "gpl-hope", "gpl-details"]),
    "lgpl-2.1-or-later-header": ("LGPL-2.1-or-later", ["lgpl-free", "lgpl-hope", "lgpl-details"]),
    "agpl-3-or-later-header": ("AGPL-3.0-or-later", ["agpl-free", "gpl-hope", "agpl-details"]),
    "bsl-text": ("BSL-1.0", ["bsl-title"]),
    "bsl-header": ("BSL-1.0", ["bsl-header"]),
    "cc0-title": ("CC0-1.0", ["cc0-title"]),
    "cc0-waiver": ("CC0-1.0", ["cc0-waiver"]),
    "unlicense-text": ("Unlicense", ["unlicense-free", "unlicense-anyone"]),
    "zlib-text": ("Zlib", ["zlib-as-is", "zlib-grant", "zlib-origin", "zlib-altered", "zlib-keep"]),
    "apache-text": ("Apache-2.0", ["apache-title", "apache-terms", "apache-copyright"]),
}
GRANTS |= {f"spdx-{x}": (x, [f"spdx-{x}"]) for x in SPDX}

#: Those and the line that grants nothing.
RULES = GRANTS | {"all-rights-reserved": ("proprietary", ["rights-reserved"])}

#: Known sentences that may stand between a rule's sentences like unknown ones.
PASSED_OVER = ("rights-reserved",)
APART = 60  # pieces at most from the beginning of one of a rule's sentences to that of the next


def sentences_of(text: Column) -> Column:
    """Pieces between line ends, and between blanks after a full stop, exclamation or question mark, colon or semicolon in a line."""
    return F.split(F.regexp_replace(text, r"([^ \t\r\n][.!?:;])[ \t\r]+", "$1\n"), "\n")


def normalise(sentence: Column) -> Column:
    """A-Z lower-cased, runs of anything but 0-9, a-z and non-ASCII signs made one blank, none at the ends."""
    return F.trim(F.regexp_replace(ascii_lower(sentence), r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", " "))


def recognise(docs: DataFrame, sentences: dict[str, str] = SENTENCES) -> DataFrame:
    """(doc_id, text_key, at, id): the known sentences of each document, by the place of their first piece.

    A sentence is one piece, or is wrapped over pieces that follow one another; these may be indented or begin with the
    signs of a comment, which normalise() drops, but none between them may be blank. Of the sentences that begin at one
    place the longest counts. The table of known sentences is a parameter of a fixed size, so it is broadcast. Only
    pieces that a known sentence begins with are taken out of a text, with what follows, as far as the longest may reach.
    """
    spark = docs.sparkSession
    split = [(k, s.split(" ")) for k, s in sentences.items()]
    begins = [(k, " ".join(w[:n]), " ".join(w[n:]), len(w)) for k, w in split for n in range(1, len(w) + 1)]
    known = F.broadcast(spark.createDataFrame(begins, "id string, piece string, rest string, n_words int"))
    first, longest, most = sorted({x[1] for x in begins}), max(map(len, sentences.values())), max(len(w) for _, w in split)

    def begin(pieces: Column) -> Column:
        """(at, piece, ahead) of each piece that a known sentence begins with."""
        ahead = lambda i: F.left(F.array_join(F.transform(F.slice(pieces, i + 2, most), lambda x: F.left(x, F.lit(longest + 1))), "\n"), F.lit(longest + 1))
        found = lambda x, i: F.when(x.isin(first), F.struct(i.alias("at"), x.alias("piece"), ahead(i).alias("ahead")))
        return F.filter(F.transform(pieces, found), lambda x: x.isNotNull())

    # Pieces are bound to a name by the outer transform, else they would be made again for each of them.
    pieces = F.transform(sentences_of(F.col("text")), normalise)
    likely = docs.select(
        "doc_id", F.xxhash64("text").alias("text_key"),
        F.explode(F.element_at(F.transform(F.array(pieces), begin), 1)).alias("one"),
    ).select("doc_id", "text_key", "one.*")
    size = F.length("rest")
    wrapped = (F.translate(F.substring("ahead", F.lit(1), size), "\n", " ") == F.col("rest")) & F.substring("ahead", size + 1, F.lit(1)).isin("", "\n")
    matched = likely.join(known, "piece").where((F.col("rest") == "") | wrapped)
    return matched.groupBy("doc_id", "text_key", "at").agg(F.max_by("id", "n_words").alias("id"))


def detect(
    docs: DataFrame, sentences: dict[str, str] = SENTENCES, rules: dict[str, tuple[str, list[str]]] = GRANTS,
    passed_over: tuple[str, ...] = PASSED_OVER, apart: int = APART,
) -> DataFrame:
    """(doc_id, rule, license, first_sentence, last_sentence): every place where a rule's sentences follow one another.

    Places count the pieces of the text from 0, a sentence by its first. Sentences that are not known, or are passed over,
    may stand between a rule's sentences, which begin `apart` pieces from one another at most; known ones of other
    identifiers may not. Without `rules` only licences that grant something are reported. Null, empty and blank texts have
    no known sentences. Repeated rows with the same text are reported once; a null doc_id is reported as null, and rows that
    share an id are told apart by their texts. Sentences are normalised before they are compared, so capitals, punctuation,
    blanks and line ends inside of them don't matter. A match of a rule that is the beginning of a longer match at the same
    place is left out. Very long texts are searched whole. An empty table gives no rows. Other columns are not read.

    Only recognised sentences are shuffled; a document's list of them is at most as long as its text, however many
    documents share a licence.
    """
    spark = docs.sparkSession
    rows = [(name, license_, ids[0], ids) for name, (license_, ids) in rules.items()]
    ruled = F.broadcast(spark.createDataFrame(rows, "rule string, license string, first_id string, ids array<string>"))
    by_text = ["doc_id", "text_key"]
    lists = recognise(docs, sentences).groupBy(*by_text).agg(F.sort_array(F.collect_set(F.struct("at", "id"))).alias("found"))
    between = lambda x: x["id"].isin(*passed_over) if passed_over else F.lit(False)
    # What is passed over is a list of its own, so each text has one list of the others and one for each of these.
    own = F.transform(F.filter("found", between), lambda x: F.array(x))
    lists = lists.select(*by_text, F.explode(F.concat(F.array(F.filter("found", lambda x: ~between(x))), own)).alias("found"))
    starts = lists.select(*by_text, "found", F.posexplode("found").alias("start", "one"))
    starts = starts.join(ruled, F.col("one.id") == F.col("first_id"))
    run = F.slice("found", F.col("start") + 1, F.size("ids"))
    near = F.forall(F.sequence(F.lit(1), F.size("run")), lambda i: (i == 1) | (F.element_at("run", i)["at"] - F.element_at("run", F.greatest(i - 1, F.lit(1)))["at"] <= apart))
    matches = starts.withColumn("run", run).where((F.col("run.id") == F.col("ids")) & near)
    longest = F.max(F.size("ids")).over(Window.partitionBy(*by_text, "one.at"))
    matches = matches.withColumn("longest", longest).where(F.size("ids") == F.col("longest"))
    return matches.select(
        "doc_id", "rule", "license", F.col("one.at").alias("first_sentence"), F.element_at("run", -1)["at"].alias("last_sentence")
    )
