"""Licence scans on paragraphs that the training texts do not hold."""

from transitlake.llm import license_scan, licences
from transitlake.llm.licences import UNKNOWN

DOCS = "doc_id bigint, text string, hits string, family string"

# (family, paragraph): usual wordings, wrapped and shortened, none of them trained on
HELD = [
 ("mit","Copyright 2021 the authors. Use, copying and modification are governed by the MIT license in the LICENSE file."),
 ("mit","THE SOFTWARE IS PROVIDED AS IS, WITHOUT WARRANTY OF ANY KIND. IN NO EVENT SHALL THE AUTHORS BE\nLIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY ARISING FROM THE SOFTWARE OR OTHER DEALINGS IN THE SOFTWARE"),
 ("apache","Unless agreed to in writing, the work is distributed on an AS IS BASIS, without warranties or\nconditions of any kind; see the License for the specific language governing permissions and limitations."),
 ("apache","All sources in this directory come under version 2.0 of the Apache License"),
 ("bsd","Redistributions in source or binary form must retain the copyright notice, this list of conditions\nand the following disclaimer in the documentation."),
 ("bsd","The names of the contributors may not be used to endorse or promote products derived from this\nsoftware without prior written permission of the copyright holder."),
 ("gpl","foobar is free software; you may redistribute and modify it under the GNU General Public License\nas published by the Free Software Foundation, version 2 or any later version"),
 ("gpl","A copy of the GNU General Public License should have come with this program, see www.gnu.org/licenses"),
 ("lgpl","Linking is allowed, since the library is covered by the GNU Lesser General Public License version 3"),
 ("agpl","The server is covered by the GNU Affero General Public License, version 3 or later"),
 ("isc","Permission to copy, modify and distribute this software for any purpose with or without fee is\ngranted, provided that the copyright notice appears in all copies"),
 ("mpl","Files here are subject to the Mozilla Public License, version 2.0"),
 ("epl","These materials are made available under the Eclipse Public License which accompanies this distribution"),
 ("boost","Use, modification and distribution are subject to the Boost Software License, Version 1.0."),
 ("eupl","The tool may be used in compliance with the European Union Public Licence, version 1.2"),
 ("zlib","Altered versions must be plainly marked and must not be misrepresented as being the original software."),
 ("cc-by-sa","Content on this site is shared under Creative Commons Attribution-ShareAlike 4.0"),
 ("cc-by","Figures may be reused under the Creative Commons Attribution 4.0 licence"),
 ("public-domain","The author places this text in the public domain and waives all copyright under CC0"),
 ("proprietary","No part of this book may be reproduced in any form without the written permission of the publisher."),
 ("unknown","Licensed under the Ruby Public License version 3"),
 ("unknown","This package comes under the Academic Community License"),
]
CLEAN = [
 "The minister said the new law would give people the right to use public roads free of charge.",
 "He renewed his fishing license last week and paid the fee in cash.",
 "Copy the source files to the folder, modify the settings and run the program.",
 "The university of the state is a member of the international union of libraries.",
 "Damages from the storm were so large that the warranty of the roof was of no use.",
 "She is an artistic director with a dedicated team and free hours.",
 "The general public may visit the foundation in version two of the house.",
 "Version 2.0 was faster than version 1.2 in all tests, with or without the cache.",
 "Der Mann geht mit dem Hund und mit der Katze zum Markt.",
 "The commons of the village were grazed by sheep of all the families.",
 "An eclipse of the moon and a boost to the economy came in the same week.",
 "A particular purpose of the meeting was to limit the liability of the owner in the contract.",
]


def documents(spark, texts):
    return spark.createDataFrame([(i, t, "x", "mit") for i, t in enumerate(texts)], DOCS)


def test_held_out_paragraphs(spark):
    """Precision 1.0 and recall at least 0.9 on paragraphs outside training."""
    trained = {t for texts in licences.NOTICES.values() for t in texts}
    assert not trained & {t.replace("\n", " ") for _, t in HELD}
    found = license_scan.scan(documents(spark, [t for _, t in HELD] + CLEAN)).collect()
    assert all(r.doc_id < len(HELD) for r in found)  # clean sentences are left alone
    best = {}
    for r in found:
        best.setdefault(r.doc_id, []).append(r)
    right = sum(HELD[i][0] in {r.family for r in rows} for i, rows in best.items())
    named = [r for r in found if r.family != UNKNOWN]
    assert right >= 0.9 * len(HELD)
    assert all(r.family == HELD[r.doc_id][0] for r in named)
    assert not any(r.confirmed for r in found if r.family == UNKNOWN)
    assert all(r.similarity is None for r in found if r.family == UNKNOWN)


def test_wrapped_paragraph_is_one(spark):
    mit = next(t for t in licences.NOTICES["mit"] if "deal in the Software" in t)
    words, lines, line = mit.split(), [], ""
    for w in words:
        if len(line) + len(w) > 70:
            lines.append(line)
            line = ""
        line = f"{line} {w}".strip()
    lines.append(line)
    text = "A title\n\n" + "\n".join(lines) + "\n\nThe end."
    got = license_scan.scan(documents(spark, [text])).collect()
    assert [(r.line_no, r.n_lines, r.family, r.confirmed) for r in got] == [(3, len(lines), "mit", True)]
    assert got[0].similarity == 1.0


def paragraphs_by_hand(text):
    out = []
    lines = (text or "").split("\n")
    for i, line in enumerate(lines):
        before = lines[i - 1].rstrip(" ") if i else ""
        ended = before.rstrip("\"')]")[-1:] in tuple(".:;!?") if before else True
        if i and len(before) >= license_scan.WRAPPED and line.strip(" ") and not ended:
            out[-1][1] += 1
            out[-1][2] += " " + line
        else:
            out.append([i + 1, 1, line])
    return [tuple(x) for x in out]


def test_paragraphs_and_scores_by_hand(spark):
    """Paragraphs, probabilities and similarities against a plain version."""
    long = "x" * 50
    texts = [t for _, t in HELD[:8]] + [
        None, "", "\n", f"{long}\n{long}.\n{long}", f"{long}\n\n{long}", f"{long}.\")\nb", "gpl " * 40_000,
        "Licensed under the Foo Public License", "Released under the MIT License.", "Released under the MIT License.",
    ]
    docs = documents(spark, texts)
    got = sorted((r.doc_id, r.line_no, r.n_lines, r.paragraph) for r in license_scan.paragraphs(docs).collect())
    assert got == [(i, *p) for i, t in enumerate(texts) for p in paragraphs_by_hand(t)]
    families, weights, bias, heat = license_scan.trained()
    want = {}
    for i, line_no, _, text in got:
        hits = {f for f in license_scan.features(text) if f in weights}
        if not hits or (len(hits) == 1 and not hits & license_scan.telling()):
            continue
        p = license_scan._probabilities(weights, bias, hits, heat)
        if p[0] >= 0.5:
            continue
        k = max(range(1, len(p)), key=lambda j: (p[j], -j))
        family = families[k] if p[k] >= 0.5 else UNKNOWN
        shares = [
            len(hits & license_scan.features(t)) / len(license_scan.features(t))
            for t in licences.NOTICES[family]
        ]
        want[i, line_no] = (family, round(p[k], 3), None if family == UNKNOWN else round(max(shares), 6))
    rows = license_scan.scan(docs).collect()
    assert {(r.doc_id, r.line_no): (r.family, round(r.probability, 3), r.similarity) for r in rows} == want
    assert len(rows) == len(want) and (16, 1) in want and (17, 1) in want
    assert license_scan.scan(docs.limit(0)).count() == 0
