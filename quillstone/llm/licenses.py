"""License scans: normalised text against licence templates by Dice coefficient over word bigrams; DataFrame functions only.

A text is put in lower case and everything but letters a-z and digits becomes one space. A template's coefficient is the best over windows
of the text's words, wherever they lie: a notice inside a sentence, a licence of several paragraphs inside a README, a whole file. A
window's distinct word bigrams A are compared with the template's B: dice = 2 |A and B| / (|A| + |B|). Windows begin at a bigram of
the template (at every STEPS-th part of a long one's) and have LENGTHS times the template's bigrams, cut at the text's end.

Size bounds prune first: dice can reach the threshold only with threshold / (2 - threshold) of B in the text. So of any part of B all but
the rest must be there; the part taken is B's longest bigrams, its anchors, which ordinary text lacks. Texts without enough anchors of any
template never see a window. Bigrams are compared by 64-bit hash. The templates are literals of the plan: nothing is shuffled, joined or
collected, and a row's answer depends on its text alone.

A text's answer is the template of highest dice (ties: the first name), with the place of its first best window.

Defined results: null, empty and one-word texts, and any text if no template has two words, match nothing (null license, dice 0, no window,
0 matches); repeated rows get equal answers; a null or very large doc_id stays as it is; very long texts are scanned whole; an empty table
gives an empty result; other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Mapping
from fractions import Fraction

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import let, table

THRESHOLD = 0.8
#: Lengths of windows, in bigrams of the template, and the parts of a template's bigrams between the starts of windows.
LENGTHS, STEPS = (Fraction(2, 3), Fraction(4, 5), Fraction(1), Fraction(5, 4), Fraction(3, 2)), 64

# Public licence texts and the notices that their authors ask for.
APACHE_2 = """Apache License Version 2.0, January 2004 http://www.apache.org/licenses/ TERMS AND CONDITIONS FOR USE, REPRODUCTION, AND DISTRIBUTION
1. Definitions. "License" shall mean the terms and conditions for use, reproduction, and distribution as defined by Sections 1 through 9 of this document. "Licensor" shall mean the copyright owner or entity authorized by the copyright owner that is granting the License. "Legal Entity" shall mean the union of the acting entity and all other entities that control, are controlled by, or are under common control with that entity. For the purposes of this definition, "control" means (i) the power, direct or indirect, to cause the direction or management of such entity, whether by contract or otherwise, or (ii) ownership of fifty percent (50%) or more of the outstanding shares, or (iii) beneficial ownership of such entity. "You" (or "Your") shall mean an individual or Legal Entity exercising permissions granted by this License. "Source" form shall mean the preferred form for making modifications, including but not limited to software source code, documentation source, and configuration files. "Object" form shall mean any form resulting from mechanical transformation or translation of a Source form, including but not limited to compiled object code, generated documentation, and conversions to other media types. "Work" shall mean the work of authorship, whether in Source or Object form, made available under the License, as indicated by a copyright notice that is included in or attached to the work (an example is provided in the Appendix below). "Derivative Works" shall mean any work, whether in Source or Object form, that is based on (or derived from) the Work and for which the editorial revisions, annotations, elaborations, or other modifications represent, as a whole, an original work of authorship. For the purposes of this License, Derivative Works shall not include works that remain separable from, or merely link (or bind by name) to the interfaces of, the Work and Derivative Works thereof. "Contribution" shall mean any work of authorship, including the original version of the Work and any modifications or additions to that Work or Derivative Works thereof, that is intentionally submitted to Licensor for inclusion in the Work by the copyright owner or by an individual or Legal Entity authorized to submit on behalf of the copyright owner. For the purposes of this definition, "submitted" means any form of electronic, verbal, or written communication sent to the Licensor or its representatives, including but not limited to communication on electronic mailing lists, source code control systems, and issue tracking systems that are managed by, or on behalf of, the Licensor for the purpose of discussing and improving the Work, but excluding communication that is conspicuously marked or otherwise designated in writing by the copyright owner as "Not a Contribution." "Contributor" shall mean Licensor and any individual or Legal Entity on behalf of whom a Contribution has been received by Licensor and subsequently incorporated within the Work.
2. Grant of Copyright License. Subject to the terms and conditions of this License, each Contributor hereby grants to You a perpetual, worldwide, non-exclusive, no-charge, royalty-free, irrevocable copyright license to reproduce, prepare Derivative Works of, publicly display, publicly perform, sublicense, and distribute the Work and such Derivative Works in Source or Object form.
3. Grant of Patent License. Subject to the terms and conditions of this License, each Contributor hereby grants to You a perpetual, worldwide, non-exclusive, no-charge, royalty-free, irrevocable (except as stated in this section) patent license to make, have made, use, offer to sell, sell, import, and otherwise transfer the Work, where such license applies only to those patent claims licensable by such Contributor that are necessarily infringed by their Contribution(s) alone or by combination of their Contribution(s) with the Work to which such Contribution(s) was submitted. If You institute patent litigation against any entity (including a cross-claim or counterclaim in a lawsuit) alleging that the Work or a Contribution incorporated within the Work constitutes direct or contributory patent infringement, then any patent licenses granted to You under this License for that Work shall terminate as of the date such litigation is filed.
4. Redistribution. You may reproduce and distribute copies of the Work or Derivative Works thereof in any medium, with or without modifications, and in Source or Object form, provided that You meet the following conditions: (a) You must give any other recipients of the Work or Derivative Works a copy of this License; and (b) You must cause any modified files to carry prominent notices stating that You changed the files; and (c) You must retain, in the Source form of any Derivative Works that You distribute, all copyright, patent, trademark, and attribution notices from the Source form of the Work, excluding those notices that do not pertain to any part of the Derivative Works; and (d) If the Work includes a "NOTICE" text file as part of its distribution, then any Derivative Works that You distribute must include a readable copy of the attribution notices contained within such NOTICE file, excluding those notices that do not pertain to any part of the Derivative Works, in at least one of the following places: within a NOTICE text file distributed as part of the Derivative Works; within the Source form or documentation, if provided along with the Derivative Works; or, within a display generated by the Derivative Works, if and wherever such third-party notices normally appear. The contents of the NOTICE file are for informational purposes only and do not modify the License. You may add Your own attribution notices within Derivative Works that You distribute, alongside or as an addendum to the NOTICE text from the Work, provided that such additional attribution notices cannot be construed as modifying the License. You may add Your own copyright statement to Your modifications and may provide additional or different license terms and conditions for use, reproduction, or distribution of Your modifications, or for any such Derivative Works as a whole, provided Your use, reproduction, and distribution of the Work otherwise complies with the conditions stated in this License.
5. Submission of Contributions. Unless You explicitly state otherwise, any Contribution intentionally submitted for inclusion in the Work by You to the Licensor shall be under the terms and conditions of this License, without any additional terms or conditions. Notwithstanding the above, nothing herein shall supersede or modify the terms of any separate license agreement you may have executed with Licensor regarding such Contributions.
6. Trademarks. This License does not grant permission to use the trade names, trademarks, service marks, or product names of the Licensor, except as required for reasonable and customary use in describing the origin of the Work and reproducing the content of the NOTICE file.
7. Disclaimer of Warranty. Unless required by applicable law or agreed to in writing, Licensor provides the Work (and each Contributor provides its Contributions) on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied, including, without limitation, any warranties or conditions of TITLE, NON-INFRINGEMENT, MERCHANTABILITY, or FITNESS FOR A PARTICULAR PURPOSE. You are solely responsible for determining the appropriateness of using or redistributing the Work and assume any risks associated with Your exercise of permissions under this License.
8. Limitation of Liability. In no event and under no legal theory, whether in tort (including negligence), contract, or otherwise, unless required by applicable law (such as deliberate and grossly negligent acts) or agreed to in writing, shall any Contributor be liable to You for damages, including any direct, indirect, special, incidental, or consequential damages of any character arising as a result of this License or out of the use or inability to use the Work (including but not limited to damages for loss of goodwill, work stoppage, computer failure or malfunction, or any and all other commercial damages or losses), even if such Contributor has been advised of the possibility of such damages.
9. Accepting Warranty or Additional Liability. While redistributing the Work or Derivative Works thereof, You may choose to offer, and charge a fee for, acceptance of support, warranty, indemnity, or other liability obligations and/or rights consistent with this License. However, in accepting such obligations, You may act only on Your own behalf and on Your sole responsibility, not on behalf of any other Contributor, and only if You agree to indemnify, defend, and hold each Contributor harmless for any liability incurred by, or claims asserted against, such Contributor by reason of your accepting any such warranty or additional liability. END OF TERMS AND CONDITIONS"""
TEMPLATES: dict[str, str] = {
    "AGPL-3.0-notice": "This work is licensed under the GNU Affero General Public License, version 3.",
    "Apache-2.0-header": 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.',
    "Apache-2.0-notice": "Licensed under the Apache License, Version 2.0.",
    "BSD-2-Clause": 'Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.',
    "CC-BY-4.0-notice": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-NC-4.0-notice": "Licensed under CC BY-NC 4.0.",
    "CC-BY-SA-4.0-notice": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "GPL-2.0-header": "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.",
    "GPL-3.0-header": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details. You should have received a copy of the GNU General Public License along with this program. If not, see <https://www.gnu.org/licenses/>.",
    "GPL-3.0-notice": "This work is licensed under the GNU General Public License, version 3.",
    "ISC": 'Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.',
    "MIT": 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.',
    "MIT-notice": "Released under the MIT License.",
    "MPL-2.0-header": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    "Unlicense": "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.",
    "0BSD": 'Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted. THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.',
    "AGPL-3.0-header": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU Affero General Public License for more details. You should have received a copy of the GNU Affero General Public License along with this program. If not, see <https://www.gnu.org/licenses/>.",
    "Apache-2.0": APACHE_2,
    "BSD-3-Clause": 'Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.',
    "BSL-1.0": 'Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license (the "Software") to use, reproduce, display, distribute, execute, and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the Software is furnished to do so, all subject to the following: The copyright notices in the Software and this entire statement, including the above license grant, this restriction and the following disclaimer, must be included in all copies of the Software, in whole or in part, and all derivative works of the Software, unless such copies or derivative works are solely in the form of machine-executable object code generated by a source language processor. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE, TITLE AND NON-INFRINGEMENT. IN NO EVENT SHALL THE COPYRIGHT HOLDERS OR ANYONE DISTRIBUTING THE SOFTWARE BE LIABLE FOR ANY DAMAGES OR OTHER LIABILITY, WHETHER IN CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.',
    "CC0-1.0-notice": "To the extent possible under law, the author(s) have dedicated all copyright and related and neighboring rights to this software to the public domain worldwide. This software is distributed without any warranty. You should have received a copy of the CC0 Public Domain Dedication along with this software. If not, see <http://creativecommons.org/publicdomain/zero/1.0/>.",
    "EPL-2.0-notice": "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/",
    "LGPL-2.1-header": "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version. This library is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU Lesser General Public License for more details. You should have received a copy of the GNU Lesser General Public License along with this library; if not, write to the Free Software Foundation, Inc., 51 Franklin Street, Fifth Floor, Boston, MA 02110-1301 USA",
    "WTFPL": "Everyone is permitted to copy and distribute verbatim or modified copies of this license document, and changing it is allowed as long as the name is changed. DO WHAT THE FUCK YOU WANT TO PUBLIC LICENSE TERMS AND CONDITIONS FOR COPYING, DISTRIBUTION AND MODIFICATION 0. You just DO WHAT THE FUCK YOU WANT TO.",
    "Zlib": "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions: 1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required. 2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software. 3. This notice may not be removed or altered from any source distribution.",
}


def words_of(text: Column) -> Column:
    """The normalised words of a text."""
    return F.split(F.trim(F.lower(F.regexp_replace(text, "[^A-Za-z0-9]+", " "))), " ")


def bigrams_of(words: Column) -> Column:
    """Hashes of the word bigrams in order; empty for fewer than two words."""
    pairs = F.transform(F.sequence(F.lit(1), F.size(words) - 1), lambda i: F.xxhash64(F.element_at(words, i), F.element_at(words, i + 1)))
    return F.when(F.size(words) > 1, pairs).otherwise(F.array().cast("array<bigint>"))


def prepared(spark: SparkSession, templates: Mapping[str, str], threshold: float) -> list[dict]:
    """name, grams (distinct bigrams, longest text first), lengths of windows, step between starts, anchors and how many of them a text needs."""
    rows = spark.createDataFrame(sorted(templates.items()), "name string, text string").select("name", words_of(F.col("text")).alias("words"))
    out = []
    for r in rows.select("name", "words", bigrams_of(F.col("words")).alias("hashes")).collect():
        text = {h: f"{a} {b}" for h, a, b in zip(r["hashes"], r["words"], r["words"][1:])}
        grams = sorted(text, key=lambda h: (-len(text[h]), text[h]))
        if not grams:
            continue
        n, m = len(r["hashes"]), len(grams)
        missing = m - math.ceil(Fraction(str(threshold)) / (2 - Fraction(str(threshold))) * m)  # bigrams that a match may lack
        anchors = grams[: missing + 1 + m // 6]
        out.append({"name": r["name"], "grams": grams, "lengths": [math.ceil(f * n) for f in LENGTHS], "step": max(1, n // STEPS), "anchors": anchors, "needed": len(anchors) - missing})
    return out


def scan(docs: DataFrame, templates: Mapping[str, str] | None = None, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, license, dice, first_word and n_words of the best window, and n_matches (templates that reach the threshold) of each row of docs (doc_id, text)."""
    known = prepared(docs.sparkSession, TEMPLATES if templates is None else templates, threshold) if templates is None or templates else []
    answer = "struct<minus: double, name: string, first_word: int, n_words: int>"
    if known:
        numbers = lambda values, suffix="L": "array(" + ", ".join(f"{v}{suffix}" if v > -(2**63) else "cast('-9223372036854775808' as bigint)" for v in values) + ")"
        row = "named_struct('name', '{}', 'step', {}, 'needed', {}, 'lengths', {}, 'anchors', {}, 'grams', {})"
        literal = F.expr("array(" + ", ".join(row.format(t["name"].replace("\\", "\\\\").replace("'", "\\'"), t["step"], t["needed"], numbers(t["lengths"], ""), numbers(t["anchors"]), numbers(sorted(t["grams"]))) for t in known) + ")")
        anchors, every = sorted({a for t in known for a in t["anchors"]}), sorted({g for t in known for g in t["grams"]})

        def best_window(grams: Column, places: Column, t: Column) -> Column:
            """The best window of the text for a template, as (-dice, name, first word, words)."""
            starts = F.filter(F.filter(places, lambda i: F.array_contains(t["grams"], F.element_at(grams, i))), lambda _, at: at % t["step"] == 0)
            dice = lambda u: F.lit(2.0) * F.size(F.array_intersect(u, t["grams"])) / (F.size(u) + F.size(t["grams"]))
            window = lambda i, n: F.struct((-let(F.array_distinct(F.slice(grams, i, n)), dice)).alias("minus"), t["name"].alias("name"), i.alias("first_word"), (F.least(n, F.size(grams) - i + 1) + 1).alias("n_words"))
            return F.array_min(F.transform(starts, lambda i: F.array_min(F.transform(t["lengths"], lambda n: window(i, n)))))

        def matches_of(grams: Column) -> Column:
            found = F.array_distinct(F.filter(grams, lambda g: g.isin(anchors)))
            wanted = lambda found: F.filter(literal, lambda t: F.size(F.array_intersect(found, t["anchors"])) >= t["needed"])
            places = lambda: F.filter(F.sequence(F.lit(1), F.size(grams)), lambda i: F.element_at(grams, i).isin(every))
            compared = lambda ts: F.when(F.size(ts) > 0, let(places(), lambda at: F.transform(ts, lambda t: best_window(grams, at, t))))
            return F.when(F.size(found) > 0, let(let(found, wanted), compared))

        # one expression, exploded as it is: a filter on a column of it would have it computed again
        matches = let(let(words_of(F.coalesce("text", F.lit(""))), bigrams_of), matches_of)
        matches = F.filter(F.coalesce(matches, F.array().cast(f"array<{answer}>")), lambda w: -w["minus"] >= threshold)
    else:
        matches = F.array().cast(f"array<{answer}>")
    best = let(matches, lambda found: F.struct(F.array_min(found).alias("best"), F.size(found).cast("long").alias("n_matches")))
    out = docs.select("doc_id", F.explode(F.array(best)).alias("w"))
    return out.select("doc_id", F.col("w.best.name").alias("license"), F.coalesce(-F.col("w.best.minus"), F.lit(0.0)).alias("dice"), F.col("w.best.first_word").alias("first_word"), F.col("w.best.n_words").alias("n_words"), "w.n_matches")


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents", "doc_id", "text"))


def _oracle() -> str:
    rows = ",\n    ".join("('{}', '{}')".format(name, text.replace("'", "''")) for name, text in sorted(TEMPLATES.items()))
    grams = "[w[i] || ' ' || w[i + 1] for i in range(1, len(w))]"
    lengths = ", ".join(f"({f.numerator} * n + {f.denominator - 1}) // {f.denominator}" for f in LENGTHS)
    return rf"""
WITH templates(name, text) AS (VALUES
    {rows}),
t AS (
  SELECT name, list_distinct(g) AS g, len(list_distinct(g)) AS m, len(g) AS n FROM (
    SELECT name, {grams} AS g FROM (SELECT name, string_split(trim(lower(regexp_replace(text, '[^A-Za-z0-9]+', ' ', 'g'))), ' ') AS w FROM templates))),
d AS (
  SELECT row_number() OVER () AS rn, doc_id, {grams} AS g FROM (SELECT doc_id, string_split(trim(lower(regexp_replace(coalesce(text, ''), '[^A-Za-z0-9]+', ' ', 'g'))), ' ') AS w FROM documents)),
shared AS (
  SELECT rn, name FROM (SELECT DISTINCT rn, unnest(g) AS gram FROM d) JOIN (SELECT name, m, unnest(g) AS gram FROM t) USING (gram) GROUP BY rn, name, m HAVING 3 * count(*) >= 2 * m),
starts AS (
  SELECT rn, name, g AS dg, tg, m, n, unnest(list_filter(hits, lambda x, i: (i - 1) % greatest(1, n // {STEPS}) = 0)) AS s FROM (
    SELECT rn, name, d.g, t.g AS tg, m, n, list_filter(range(1, len(d.g) + 1), lambda i: list_contains(t.g, d.g[i])) AS hits FROM shared JOIN d USING (rn) JOIN t USING (name))),
windows AS (SELECT rn, name, tg, m, s, l, len(dg) AS size, list_distinct(dg[s:s + l - 1]) AS u FROM (SELECT *, unnest([{lengths}]) AS l FROM starts)),
scored AS (SELECT rn, name, s, least(l, size - s + 1) + 1 AS n_words, 2.0::DOUBLE * len(list_intersect(u, tg)) / (len(u) + m) AS dice FROM windows),
best AS (
  SELECT rn, first(name ORDER BY dice DESC, name, s, n_words) AS license, max(dice) AS dice, first(s ORDER BY dice DESC, name, s, n_words)::INT AS first_word, first(n_words ORDER BY dice DESC, name, s, n_words)::INT AS n_words,
    count(DISTINCT name) AS n_matches FROM scored WHERE dice >= 0.8 GROUP BY rn)
SELECT d.doc_id, b.license, coalesce(b.dice, 0.0)::DOUBLE AS dice, b.first_word, b.n_words, coalesce(b.n_matches, 0)::BIGINT AS n_matches
FROM d LEFT JOIN best b USING (rn)
"""


QUERIES = {"op7_license_scan": op7_license_scan}
ORACLES = {"op7_license_scan": _oracle()}
