"""License scans by canonical digest lookup.

A text is brought to a canonical form (case, punctuation, copyright owners and
equivalent spellings no longer matter), hashed, and joined to the digests of
known licence texts. The same lookup is made for each line, which finds the
one-line notices inside longer documents.

The known list is a constant of this module, so its join side has a fixed,
small size and is broadcast; the corpus is scanned once and never shuffled.

Defined results: null and empty texts have an empty canonical form, which
matches nothing (digest of the empty string); whole texts are hashed, however
long; repeated rows are judged row by row; an empty table gives an empty result; extra columns are kept by
``identify`` and added columns take a free name.
"""

from __future__ import annotations

import hashlib
import itertools
import pkgutil
import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import free_name, let, quoted

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: FIXED VALUES: words behind 'copyright' that do not name an owner.
NO_OWNER = "notice|holder|owner|licen[cs]e|law|and[ \t]|statement|permission|interest"
#: FIXED VALUES: a line that names a copyright owner (lower case): 'copyright'
#: or '(c)' before a year (or its placeholder), a mark or 'by'; a line that
#: begins with the sign; '(c) copyright <owner>'; or a paragraph of one line
#: 'copyright <owner>', which is never the rest of a wrapped sentence.
OWNER_LINE = (
    r"(?:^|\n)[ \t]*(?:©"
    r"|(?:copyright|\(c\))[ \t,:]*(?:©|&copy;|\(c\)|by[ \t]|[\[{<(]?(?:[0-9]{4}|yyyy|year)(?![a-z0-9]))"
    rf"|\(c\)[ \t]*copyright[ \t]+(?!{NO_OWNER})[^ \t\r\n]"
    r")[^\n]*"
    rf"|(?:^[ \t\r]*\n|^|\n[ \t\r]*\n)[ \t]*copyright[ \t]+(?!{NO_OWNER})[^ \t\r\n][^\n]*(?=\n[ \t\r]*\n|\n?[ \t\r]*(?![\s\S]))"
)
#: FIXED VALUES: equivalent spellings, applied in this order to lower-case words.
SPELLINGS = (
    ("licence", "license"),
    ("sublicence", "sublicense"),
    ("non infringement", "noninfringement"),
    ("whilst", "while"),
    ("favour", "favor"),
    ("https", "http"),
    ("acknowledgement", "acknowledgment"),
    ("organisation", "organization"),
    ("version 2 0", "version 2"),
    ("v2 0", "version 2"),
    ("gnu gpl", "gnu general public license"),
)
#: FIXED VALUES: known licence texts and notices, as published.
KNOWN = {
    "MIT": """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
    "ISC": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.""",
    "0BSD": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.""",
    "Zlib": """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software.

Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:

1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required.
2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.
3. This notice may not be removed or altered from any source distribution.""",
    "BSD-2-Clause": """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.

THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.""",
    "BSL-1.0": """Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license (the "Software") to use, reproduce, display, distribute, execute, and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the Software is furnished to do so, all subject to the following:

The copyright notices in the Software and this entire statement, including the above license grant, this restriction and the following disclaimer, must be included in all copies of the Software, in whole or in part, and all derivative works of the Software, unless such copies or derivative works are solely in the form of machine-executable object code generated by a source language processor.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE, TITLE AND NON-INFRINGEMENT. IN NO EVENT SHALL THE COPYRIGHT HOLDERS OR ANYONE DISTRIBUTING THE SOFTWARE BE LIABLE FOR ANY DAMAGES OR OTHER LIABILITY, WHETHER IN CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
    "Unlicense": """This is free and unencumbered software released into the public domain.

Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.

In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright interest in the software to the public domain. We make this dedication for the benefit of the public at large and to the detriment of our heirs and successors. We intend this dedication to be an overt act of relinquishment in perpetuity of all present and future rights to this software under copyright law.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.

For more information, please refer to <https://unlicense.org>""",
    "Apache-2.0 notice": "Licensed under the Apache License, Version 2.0.",
    "MIT notice": "Released under the MIT License.",
    "GPL-3.0 notice": "This work is licensed under the GNU General Public License, version 3.",
    "CC-BY-NC-4.0 notice": "Licensed under CC BY-NC 4.0.",
    "All rights reserved": "All rights reserved.",
}

KNOWN["BSD-3-Clause"] = KNOWN["BSD-2-Clause"].replace(
    "\n\nTHIS SOFTWARE IS", "\n\n3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.\n\nTHIS SOFTWARE IS"
)
KNOWN["MIT-0"] = KNOWN["MIT"].replace(", subject to the following conditions:", ".").replace(
    "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.\n\n", ""
)
#: FIXED VALUES: title lines under which the short texts are published.
TITLES = {
    "MIT": ("MIT License", "The MIT License", "The MIT License (MIT)", "MIT License (MIT)"),
    "ISC": ("ISC License", "The ISC License", "ISC License (ISC)", "The ISC License (ISC)"),
    "0BSD": ("BSD Zero Clause License", "Zero-Clause BSD", "Zero Clause BSD License", "BSD Zero Clause License (0BSD)", "Zero-Clause BSD (0BSD)"),
    "Zlib": ("zlib License", "The zlib License", "zlib/libpng License", "The zlib/libpng License", "The zlib/libpng License (Zlib)"),
    "BSD-2-Clause": ("BSD 2-Clause License", "The BSD 2-Clause License", "The 2-Clause BSD License", 'BSD 2-Clause "Simplified" License', "Simplified BSD License"),
    "BSD-3-Clause": ("BSD 3-Clause License", "The BSD 3-Clause License", "The 3-Clause BSD License", 'BSD 3-Clause "New" or "Revised" License', "New BSD License"),
    "BSL-1.0": ("Boost Software License - Version 1.0 - August 17th, 2003", "Boost Software License - Version 1.0", "Boost Software License 1.0 (BSL-1.0)"),
    "Unlicense": ("The Unlicense", "Unlicense", "The Unlicense (Unlicense)"),
    "MIT-0": ("MIT No Attribution", "MIT No Attribution License", "MIT-0 License"),
}
#: FIXED VALUES: wordings of the short texts that are published as well.
WORDINGS = {
    "ISC": (("and/or distribute this", "and distribute this"),),
    "BSD-2-Clause": (("THE COPYRIGHT HOLDER OR", "THE COPYRIGHT OWNER OR"),),
    "BSD-3-Clause": (("THE COPYRIGHT HOLDER OR", "THE COPYRIGHT OWNER OR"),),
    "Unlicense": (("\n\nFor more information, please refer to <https://unlicense.org>", ""),),
}
#: FIXED VALUES: long texts, kept as published in ``license_texts``: licence
#: name -> (file, where the text begins after its title, where its appendix begins).
FILES = {
    "Apache-2.0": ("Apache-2.0", "TERMS AND CONDITIONS FOR USE", "APPENDIX: How to apply"),
    "GPL-1.0": ("GPL-1", "Copyright (C) 1989 Free", "Appendix: How to Apply"),
    "GPL-2.0": ("GPL-2", "Copyright (C) 1989, 1991 Free", "How to Apply These Terms to Your New Programs\n\n  If"),
    "GPL-3.0": ("GPL-3", "Copyright (C) 2007 Free", "How to Apply These Terms to Your New Programs\n\n  If"),
    "LGPL-2.0": ("LGPL-2", "Copyright (C) 1991 Free", "How to Apply These Terms to Your New Libraries\n\n  If"),
    "LGPL-2.1": ("LGPL-2.1", "Copyright (C) 1991, 1999 Free", "How to Apply These Terms to Your New Libraries\n\n  If"),
    "LGPL-3.0": ("LGPL-3", "Copyright (C) 2007 Free", None),
    "GFDL-1.2": ("GFDL-1.2", "Copyright (C) 2000,2001,2002", "ADDENDUM: How to use"),
    "GFDL-1.3": ("GFDL-1.3", "Copyright (C) 2000, 2001, 2002, 2007", "ADDENDUM: How to use"),
    "MPL-1.1": ("MPL-1.1", "1. Definitions.", "EXHIBIT A -Mozilla"),
    "MPL-2.0": ("MPL-2.0", "1. Definitions", "Exhibit A - Source Code Form"),
    "CC0-1.0": ("CC0-1.0", "Statement of Purpose", None),
    "Artistic-1.0": ("Artistic", "Preamble", None),
    "BSD-3-Clause (Regents)": ("BSD", "Redistribution and use", None),
}


def beginnings(form: str) -> set[tuple[str, ...]]:
    """The first three words of every text whose canonical form is ``form``:
    spellings are undone from the last to the first, each at any of its places."""
    # No spelling has over four words, so later words cannot reach the first three.
    heads = {" ".join(form.split(" ")[:12])}
    for other, ours in reversed(SPELLINGS):
        for h in list(heads):
            first, *rest = h.split(ours)
            heads |= {first + "".join(w + r for w, r in zip(used, rest)) for used in itertools.product((ours, other), repeat=len(rest))}
    return {tuple(h.split(" ")[:3]) for h in heads}


def known_texts() -> list[tuple[str, str]]:
    """(licence name, text) of every published form: with and without title
    lines, the line 'All rights reserved.', list numbers and appendix."""
    out = list(KNOWN.items())
    for name, titles in TITLES.items():
        bodies = [KNOWN[name]]
        bodies += [b.replace(a, z) for a, z in WORDINGS.get(name, ()) for b in list(bodies)]
        bodies += [re.sub(r"(?m)^[0-9]\. ", "", b) for b in bodies]
        heads = [t + r for t in ("", *(x + "\n\n" for x in titles)) for r in ("", "All rights reserved.\n\n")]
        out += [(name, h + b) for h in heads for b in bodies]
    for name, (file, begin, appendix) in FILES.items():
        whole = pkgutil.get_data(__package__, f"license_texts/{file}.txt").decode()
        ends = [whole] + ([whole[: whole.index(appendix)]] if appendix else [])
        out += [(name, t) for e in ends for t in (e, e[e.index(begin):])]
    return list(dict.fromkeys(out))


def canonical(text: Column) -> Column:
    """Lower case, no owner lines, words of letters and digits joined by
    one space, equivalent spellings made one."""
    t = F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)
    t = F.regexp_replace(t, OWNER_LINE, "")
    # Any run of ASCII characters other than letters and digits is one space.
    t = F.trim(F.regexp_replace(t, r"[\x00-\x2F\x3A-\x60\x7B-\x7F\x{2010}-\x{2027}\x{00A0}]+", " "))
    for other, ours in SPELLINGS:
        t = F.replace(t, F.lit(other), F.lit(ours))
    return t


def canonical_text(text: str | None) -> str:
    """``canonical`` for one string, used to hash the known list."""
    t = "".join(LOWER[UPPER.index(c)] if c in UPPER else c for c in text or "")
    t = re.sub(OWNER_LINE, "", t)
    t = re.sub("[\x00-\x2F\x3A-\x60\x7B-\x7F‐-‧ ]+", " ", t).strip(" ")
    for other, ours in SPELLINGS:
        t = t.replace(other, ours)
    return t


def known_digests(known: dict[str, str] | None = None) -> dict[str, str]:
    """Digest -> licence name."""
    return {hashlib.sha256(canonical_text(t).encode()).hexdigest(): n for n, t in (known_texts() if known is None else known.items())}


def known_table(spark: SparkSession, known: dict[str, str] | None = None) -> DataFrame:
    return spark.createDataFrame(list(known_digests(known).items()), "digest string, license string")


def identify(docs: DataFrame, text: str = "text", known: dict[str, str] | None = None) -> DataFrame:
    """``docs`` with ``digest`` (of the canonical text), ``license`` (the known
    licence that the entire text is, else null) and ``notices`` (names of known
    texts that single lines are, distinct and in order)."""
    digest, found, notices = (free_name(docs, x) for x in ("digest", "license", "notices"))
    names = known_digests(known)
    by_digest = F.create_map(*[F.lit(x) for pair in names.items() for x in pair])
    # Only lines that begin like a known text, in any spelling, are brought to canonical form.
    texts = [t for _, t in (known_texts() if known is None else known.items())]
    starts = "|".join(sorted({r"[^a-z0-9]+".join(x) for t in texts for x in beginnings(canonical_text(t))}))
    likely = F.filter(
        F.split(F.coalesce(quoted(text), F.lit("")), "\n", -1),
        lambda x: F.translate(x, UPPER, LOWER).rlike(rf"^[^a-z0-9]*({starts})([^a-z0-9]|$)"),
    )
    hit = lambda x: F.try_element_at(by_digest, F.sha2(canonical(x), 256))
    lines = let(likely, lambda ls: F.array_sort(F.array_distinct(F.filter(F.transform(ls, hit), lambda v: v.isNotNull()))))
    known_digest, known_license = free_name(docs, "known_digest"), free_name(docs, "known_license")
    out = docs.withColumn(digest, F.sha2(canonical(quoted(text)), 256)).withColumn(notices, lines)
    table = known_table(docs.sparkSession, known).select(F.col("digest").alias(known_digest), F.col("license").alias(known_license))
    joined = out.join(F.broadcast(table), F.col(digest) == F.col(known_digest), "left")
    return joined.select(*[quoted(c) for c in docs.columns], digest, F.col(known_license).alias(found), notices)


def report(docs: DataFrame, text: str = "text", key: str = "doc_id", known: dict[str, str] | None = None) -> DataFrame:
    got = identify(docs.select(quoted(key).alias("key"), quoted(text).alias("text")), "text", known)
    return got.select(F.col("key").alias(key), "digest", "license", F.array_join("notices", ",").alias("notices"))
