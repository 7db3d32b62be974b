"""DuckDB SQL for those queries of this subpackage that SQL can express.

The licence scan is stated anew here: the same rules as nested replacements,
and known texts compared as canonical texts instead of digests.
"""

from __future__ import annotations

# Fixed values: (identifier, notice).
_NOTICES = """
('Apache-2.0', 'Licensed under the Apache License, Version 2.0.'),
('Apache-2.0', 'SPDX-License-Identifier: Apache-2.0'),
('BSD-2-Clause', 'SPDX-License-Identifier: BSD-2-Clause'),
('BSD-3-Clause', 'SPDX-License-Identifier: BSD-3-Clause'),
('BSD-3-Clause', 'Licensed under the BSD 3-Clause License.'),
('CC-BY-4.0', 'Licensed under CC BY 4.0.'),
('CC-BY-4.0', 'This work is licensed under a Creative Commons Attribution 4.0 International License.'),
('CC-BY-NC-4.0', 'Licensed under CC BY-NC 4.0.'),
('CC-BY-NC-4.0', 'This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.'),
('CC-BY-SA-4.0', 'Licensed under CC BY-SA 4.0.'),
('CC-BY-SA-4.0', 'This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.'),
('CC0-1.0', 'Dedicated to the public domain under CC0 1.0.'),
('GPL-2.0', 'This work is licensed under the GNU General Public License, version 2.'),
('GPL-3.0', 'This work is licensed under the GNU General Public License, version 3.'),
('GPL-3.0', 'SPDX-License-Identifier: GPL-3.0-only'),
('LGPL-3.0', 'This work is licensed under the GNU Lesser General Public License, version 3.'),
('MIT', 'Released under the MIT License.'),
('MIT', 'Licensed under the MIT License.'),
('MIT', 'SPDX-License-Identifier: MIT'),
('MPL-2.0', 'This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.'),
('reserved', 'All rights reserved.'),
('Unlicense', 'This is free and unencumbered software released into the public domain.')
"""

_RULES = [
    (r"\(c\)|©", "copyright "), (r"https?://(www\.)?", ""), (r"\blicence", "license"),
    (r"\blicencing\b", "licensing"), (r"\bsub-?licen[cs]e", "sublicense"), (r"\bnon-?commercial", "noncommercial"),
    (r"\bshare-?alike", "sharealike"), (r"\bversion ([0-9])", r"\1"), (r"\bv\.? ?([0-9])", r"\1"),
    (r"\borganis", "organiz"), (r"\bauthoris", "authoriz"), (r"\bmerchantib", "merchantab"),
    (r"(^|\n)[^a-z0-9\n]*copyright\b[^\n]*[0-9]{4}[^\n]*", r"\1"), (r"[^\p{L}\p{N}\n]+", " "),
]


def _form(column: str) -> str:
    out = f"lower(coalesce({column}, ''))"
    for pattern, form in _RULES:
        out = f"regexp_replace({out}, '{pattern}', '{form}', 'g')"
    return out


def _flat(column: str) -> str:
    return rf"trim(regexp_replace({column}, '[ \n]+', ' ', 'g'))"


_LICENSES = f"""
WITH notices(license_id, text) AS (VALUES {_NOTICES}),
known AS (SELECT {_flat(_form('text'))} AS form, min(license_id) AS license_id FROM notices GROUP BY 1),
docs AS (SELECT row_number() OVER () AS row_no, doc_id, {_form('text')} AS form FROM documents),
lines AS (SELECT row_no, unnest(string_split(form, chr(10))) AS line FROM docs),
hits AS (SELECT row_no, license_id FROM lines JOIN known ON {_flat('line')} = known.form WHERE known.form <> ''),
by_row AS (SELECT row_no, string_agg(DISTINCT license_id, ',' ORDER BY license_id) AS line_licenses,
           count(*) AS n FROM hits GROUP BY row_no)
SELECT doc_id, known.license_id AS document_license, coalesce(line_licenses, '') AS line_licenses,
       coalesce(n, 0)::BIGINT AS n_license_lines
FROM docs LEFT JOIN by_row USING (row_no)
LEFT JOIN known ON {_flat('docs.form')} = known.form AND known.form <> ''
"""

# Phrases counted one by one: pieces, words of a piece, every run of up to four of them.
_COLLOCATIONS = r"""
WITH pieces AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
split AS (SELECT lang, list_filter(string_split(replace(piece, chr(9), ' '), ' '), lambda x: x <> '') AS w FROM pieces),
starts AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM split),
runs AS (SELECT lang, unnest(list_transform(range(0, least(4, len(w) - i + 1)), lambda k: w[i:i + k])) AS p FROM starts),
f AS (SELECT lang, p, count(*) AS a FROM runs GROUP BY ALL),
totals AS (SELECT lang, sum(a)::BIGINT AS n FROM f WHERE len(p) = 1 GROUP BY lang),
found AS (SELECT lang, p, a FROM f WHERE len(p) > 1 AND a >= 30),
spans AS (SELECT lang, p, a, unnest(range(2, len(p))) AS size FROM found WHERE len(p) > 2),
longer AS (SELECT lang, p[i:i + size - 1] AS p, max(a) AS more
           FROM (SELECT *, unnest(range(1, len(p) - size + 2)) AS i FROM spans) GROUP BY ALL),
kept AS (SELECT lang, p, a FROM found LEFT JOIN longer USING (lang, p) WHERE more IS NULL OR 100 * more::HUGEINT < 80 * a::HUGEINT),
cuts AS (SELECT lang, p, a, unnest(range(1, len(p))) AS k FROM kept),
scored AS (SELECT c.lang, c.p, c.a, k, l.a AS l, r.a AS r, (2000000 * c.a::HUGEINT // (l.a + r.a))::BIGINT AS score
           FROM cuts c JOIN f l ON l.lang = c.lang AND l.p = c.p[1:k] JOIN f r ON r.lang = c.lang AND r.p = c.p[k + 1:]),
best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, p ORDER BY score, k) = 1),
ranked AS (SELECT *, array_to_string(p, ' ') AS phrase,
           row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, array_to_string(p, ' ')) AS rank FROM best)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
"""

ORACLE_SQL: dict[str, str] = {
    "op7_licenses": _LICENSES,
    "op11_collocations": _COLLOCATIONS,
}
