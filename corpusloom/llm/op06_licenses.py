"""License scans: canonical digest lookup of whole texts.

A text is brought to a canonical form (lower case, copyright lines dropped, punctuation and runs of
space turned into one space, equivalent spellings unified) and its digest is joined with the digests
of known licence texts in the same form.  Only whole texts match, whatever their case, layout,
punctuation, spelling or copyright holder.

Known licences are a table (name, text), a parameter.  ``known_texts`` gives the short ones of ``KNOWN``
with and without the title lines of ``TITLES`` and the numbers of their clauses, and the long ones in the
folder ``licenses`` with and without their title and what follows their terms.  The table of known
digests is broadcast up to ``BROADCAST_LICENSES`` rows and joined by shuffle beyond.  Texts are
canonicalised by expressions and never shuffled in the broadcast case; otherwise only ids and digests
are.  Regular expressions run on texts that hold their literals; spellings are literals themselves.

Results for special rows: null texts and texts without letters or digits have a null digest and no
licence; known texts with equal digests give the least name; repeated rows each have a row; whole texts
are read whatever their length; an empty table gives an empty result; further columns are not read.
"""

from __future__ import annotations

import re
from pathlib import Path

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BROADCAST_LICENSES = 50_000

#: Equivalent spellings as literals, replaced in canonical text in this order (fixed values, after public matching guidelines).
SPELLINGS = (
    ("licenc", "licens"), ("copyright owner", "copyright holder"), ("copyright holders", "copyright holder"), ("isation", "ization"), ("authoris", "authoriz"),
    ("organis", "organiz"), ("recognis", "recogniz"), ("utilis", "utiliz"), ("realis", "realiz"), ("favour", "favor"), ("labour", "labor"), ("colour", "color"),
    ("honour", "honor"), ("fulfill", "fulfil"), ("acknowledgement", "acknowledgment"), ("per cent", "percent"), ("non commercial", "noncommercial"),
    ("merchantibility", "merchantability"), ("whilst", "while"), ("https ", "http "),
)

#: Name and text of known licences (fixed values).
KNOWN = (
    (
        "MIT",
        'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), '
        "to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, "
        "and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:\n\n"
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.\n\n"
        'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, '
        "FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER "
        "LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS "
        "IN THE SOFTWARE.",
    ),
    (
        "ISC",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above "
        "copyright notice and this permission notice appear in all copies.\n\n"
        'THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF '
        "MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES "
        "WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN "
        "CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.",
    ),
    (
        "0BSD",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted.\n\n"
        'THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF '
        "MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES "
        "WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN "
        "CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.",
    ),
    (
        "Apache-2.0-notice",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a '
        "copy of the License at\n\nhttp://www.apache.org/licenses/LICENSE-2.0\n\nUnless required by applicable law or agreed to in writing, software "
        'distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the '
        "License for the specific language governing permissions and limitations under the License.",
    ),
    (
        "BSD-2-Clause",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:\n\n"
        "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.\n\n"
        "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation "
        "and/or other materials provided with the distribution.\n\n"
        'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE '
        "IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE "
        "LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE "
        "GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT "
        "LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH "
        "DAMAGE.",
    ),
    (
        "BSD-3-Clause",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:\n\n"
        "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.\n\n"
        "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation "
        "and/or other materials provided with the distribution.\n\n"
        "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software "
        "without specific prior written permission.\n\n"
        'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE '
        "IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE "
        "LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE "
        "GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT "
        "LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH "
        "DAMAGE.",
    ),
    (
        "Zlib",
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from "
        "the use of this software.\n\nPermission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it "
        "and redistribute it freely, subject to the following restrictions:\n\n"
        "1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a "
        "product, an acknowledgment in the product documentation would be appreciated but is not required.\n"
        "2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.\n"
        "3. This notice may not be removed or altered from any source distribution.",
    ),
    (
        "Unlicense",
        "This is free and unencumbered software released into the public domain.\n\nAnyone is free to copy, modify, publish, use, compile, sell, or distribute "
        "this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.\n\n"
        "In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright interest in the software to the "
        "public domain. We make this dedication for the benefit of the public at large and to the detriment of our heirs and successors. We intend this "
        "dedication to be an overt act of relinquishment in perpetuity of all present and future rights to this software under copyright law.\n\n"
        'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, '
        "FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN "
        "ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    ),
    (
        "ISC",
        "Permission to use, copy, modify, and distribute this software for any purpose with or without fee is hereby granted, provided that the above "
        "copyright notice and this permission notice appear in all copies.\n\n"
        'THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF '
        "MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES "
        "WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN "
        "CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.",
    ),
    (
        "MIT-0",
        'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), '
        "to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, "
        "and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so.\n\n"
        'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, '
        "FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER "
        "LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS "
        "IN THE SOFTWARE.",
    ),
    (
        "BSL-1.0",
        "Boost Software License - Version 1.0 - August 17th, 2003\n\n"
        "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by "
        'this license (the "Software") to use, reproduce, display, distribute, execute, and transmit the Software, and to prepare derivative works of the '
        "Software, and to permit third-parties to whom the Software is furnished to do so, all subject to the following:\n\n"
        "The copyright notices in the Software and this entire statement, including the above license grant, this restriction and the following disclaimer, must "
        "be included in all copies of the Software, in whole or in part, and all derivative works of the Software, unless such copies or derivative works are "
        "solely in the form of machine-executable object code generated by a source language processor.\n\n"
        'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, '
        "FITNESS FOR A PARTICULAR PURPOSE, TITLE AND NON-INFRINGEMENT. IN NO EVENT SHALL THE COPYRIGHT HOLDERS OR ANYONE DISTRIBUTING THE SOFTWARE BE LIABLE FOR "
        "ANY DAMAGES OR OTHER LIABILITY, WHETHER IN CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER "
        "DEALINGS IN THE SOFTWARE.",
    ),
    ("Apache-2.0-line", "Licensed under the Apache License, Version 2.0."),
    ("MIT-line", "Released under the MIT License."),
    ("GPL-3.0-line", "This work is licensed under the GNU General Public License, version 3."),
    ("CC-BY-NC-4.0-line", "Licensed under CC BY-NC 4.0."),
)

#: Title lines of the short licences (fixed values).
TITLES = {
    "MIT": ("MIT License", "The MIT License", "The MIT License (MIT)", "MIT License (MIT)"),
    "MIT-0": ("MIT No Attribution", "MIT-0"),
    "ISC": ("ISC License", "The ISC License", "ISC License (ISC)"),
    "0BSD": ("BSD Zero Clause License", "Zero-Clause BSD", "Zero-Clause BSD License", "BSD Zero Clause License (0BSD)"),
    "BSD-2-Clause": ("BSD 2-Clause License", "The 2-Clause BSD License", "The BSD 2-Clause License", "Simplified BSD License", "BSD License"),
    "BSD-3-Clause": ("BSD 3-Clause License", "The 3-Clause BSD License", "The BSD 3-Clause License", "New BSD License", "BSD License"),
    "Zlib": ("zlib License", "The zlib License", "zlib/libpng License", "The zlib/libpng License"),
    "Unlicense": ("The Unlicense", "Unlicense"),
}
#: The words that a long licence's text begins with after its title, and those after which its terms are over.
BODY = {"Apache-2.0": "TERMS AND CONDITIONS FOR USE", "MPL-2.0": "1. Definitions", "CC0-1.0": "CC0 1.0 Universal"}
TERMS_END = "END OF TERMS AND CONDITIONS"
#: Words that licences open with; a copyright notice on the same line ends before them.
OPENINGS = (
    "permission is hereby granted|permission to use|redistribution and use|this software is provided|permission is granted|licensed under|this is free and unencumbered"
    "|all rights reserved"
)


def known_texts() -> list[tuple[str, str]]:
    """Name and text of known licences in their usual forms."""
    short = [(name, form) for name, text in KNOWN for form in (text, re.sub(r"(?m)^[0-9]\. ", "", text))]
    out = short + [(name, f"{title}\n\n{text}") for name, text in short for title in TITLES.get(name, ())]
    for file in sorted((Path(__file__).parent / "licenses").glob("*.txt")):
        whole = file.read_text("utf-8")
        starts = {0, max(0, whole.find(BODY.get(file.stem, "")))}
        ends = {len(whole)} | ({whole.index(TERMS_END), whole.index(TERMS_END) + len(TERMS_END)} if TERMS_END in whole else set())
        out += [(file.stem, whole[a:b]) for a in starts for b in ends]
    return sorted(set(out))


#: What is taken out of lower-case text: (literals of which one must occur, pattern, replacement).
NOTICES = (
    (("copyright", "(c)", "©"), rf"(copyright|\(c\)|©)[^a-z\n]*(\(c\)|©|[0-9]{{4}})[^\n]{{0,200}}?[^a-z0-9\n]({OPENINGS})", r" \3"),
    (("all rights reserved",), rf"all rights reserved[^a-z0-9\n]*({OPENINGS})", r" \1"),
    (("copyright", "(c)", "©"), r"(^|\n)[^a-z0-9\n]*(copyright|\(c\)|©)[^a-z\n]*(\(c\)|©|[0-9]{4}|by[^a-z0-9])[^\n]*", r"\1 "),
    (("all rights reserved",), r"(^|\n)([^a-z0-9\n]*all rights reserved[^a-z0-9\n]*(\n|\z))+", r"\1 "),
)
#: What separates words, as one space.
SEPARATORS = r"[^\p{L}\p{N}]+"


def with_digest(rows: DataFrame, text: str = "text") -> DataFrame:
    """``rows`` with the column ``digest`` of the canonical form in place of ``text``; null where that is empty.

    One projection for each step, so that no step is evaluated twice.
    """
    rows = rows.withColumn(text, F.lower(text))
    for literals, pattern, replacement in NOTICES:
        held = F.lit(False)
        for literal in literals:
            held = held | F.contains(F.col(text), F.lit(literal))
        rows = rows.withColumn(text, F.when(held, F.regexp_replace(text, pattern, replacement.replace("\\", "$"))).otherwise(F.col(text)))
    pairs = F.array(*(F.struct(F.lit(a).alias("a"), F.lit(b).alias("b")) for a, b in SPELLINGS))
    # A fold over the pairs, since the code of nested replacements would pass the limit of a method.
    form = F.aggregate(pairs, F.btrim(F.regexp_replace(text, SEPARATORS, " ")), lambda done, pair: F.replace(done, pair["a"], pair["b"]))
    rows = rows.withColumn(text, form)
    return rows.withColumn("digest", F.sha2(F.nullif(F.col(text), F.lit("")).cast("binary"), 256)).drop(text)


def scan_licenses(docs: DataFrame, known: DataFrame | None = None, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, digest and license (null if none) of each row."""
    if known is None:
        known = docs.sparkSession.createDataFrame(known_texts(), "name string, text string")
    names = with_digest(known.select("text", "name")).groupBy("digest").agg(F.min("name").alias("license"))
    if known.count() <= BROADCAST_LICENSES:
        names = F.broadcast(names)
    rows = with_digest(docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text")))
    return rows.join(names, "digest", "left").select("doc_id", "digest", "license")
