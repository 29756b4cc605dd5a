"""The size-bounded splitter once more in SQL, for the oracle: cuts, greedy packing as a fold, recursion over separators."""

from __future__ import annotations

from . import sqlbits as S

# ---------------------------------------------------------------------------
# Separators in the order in which they are tried, for the languages that the tables' files have; all
# other languages use the last list.
# ---------------------------------------------------------------------------
SEPARATORS = {
    "python": ["\nclass ", "\ndef ", "\n\tdef ", "\n\n", "\n", " ", ""],
    "java": ["\nclass ", "\npublic ", "\nprotected ", "\nprivate ", "\nstatic ", "\nif ", "\nfor ", "\nwhile ", "\nswitch ", "\ncase ",
             "\n\n", "\n", " ", ""],
    "typescript": ["\nenum ", "\ninterface ", "\nnamespace ", "\ntype ", "\nclass ", "\nfunction ", "\nconst ", "\nlet ", "\nvar ", "\nif ",
                   "\nfor ", "\nwhile ", "\nswitch ", "\ncase ", "\ndefault ", "\n\n", "\n", " ", ""],
    "go": ["\nfunc ", "\nvar ", "\nconst ", "\ntype ", "\nif ", "\nfor ", "\nswitch ", "\ncase ", "\n\n", "\n", " ", ""],
    "rust": ["\nfn ", "\nconst ", "\nlet ", "\nif ", "\nwhile ", "\nfor ", "\nloop ", "\nmatch ", "\n\n", "\n", " ", ""],
    "kotlin": ["\nclass ", "\npublic ", "\nprotected ", "\nprivate ", "\ninternal ", "\ncompanion ", "\nfun ", "\nval ", "\nvar ", "\nif ",
               "\nfor ", "\nwhile ", "\nwhen ", "\ncase ", "\nelse ", "\n\n", "\n", " ", ""],
    "c": ["\nclass ", "\nvoid ", "\nint ", "\nfloat ", "\ndouble ", "\nif ", "\nfor ", "\nwhile ", "\nswitch ", "\ncase ", "\n\n", "\n", " ", ""],
    "cpp": ["\nclass ", "\nvoid ", "\nint ", "\nfloat ", "\ndouble ", "\nif ", "\nfor ", "\nwhile ", "\nswitch ", "\ncase ", "\n\n", "\n", " ", ""],
    "": ["\n\n", "\n", " ", ""],
}
# ---------------------------------------------------------------------------


def _list(seps: list[str]) -> str:
    return "[" + ", ".join("'" + s.replace("\n", "' || chr(10) || '").replace("\t", "' || chr(9) || '") + "'" for s in seps) + "]"


def separators(language: str) -> str:
    whens = " ".join(f"WHEN '{k}' THEN {_list(v)}" for k, v in SEPARATORS.items() if k)
    return f"(CASE {language} {whens} ELSE {_list(SEPARATORS[''])} END)"


def chunks(source: str, key: str) -> str:
    """CTEs that end in ``pieces`` (key, chunk_index, c), the chunks of the ``source`` rows (key, route, language, content,
    chunk_size) of routes 'whole' and 'split'. A text is cut before each occurrence of the first separator that it has;
    pieces are joined while they stay within the size, and a piece of that size or more is a text of its own, for the
    separators behind. Separators here hold nothing special in a regular expression."""
    cut = "list_filter(string_split(replace(text, chosen, chr(1) || chosen), chr(1)), lambda x: x <> '')"
    flush = "CASE WHEN s.buf <> '' THEN list_append(s.done, {'t': s.buf, 'big': false}) ELSE s.done END"
    fold = f"""list_reduce(list_transform(cuts, lambda x: {{'buf': x, 'done': CAST([] AS STRUCT(t VARCHAR, big BOOLEAN)[])}}), lambda s, p:
      CASE WHEN length(p.buf) >= size THEN {{'buf': '', 'done': list_append({flush}, {{'t': p.buf, 'big': true}})}}
           WHEN s.buf <> '' AND length(s.buf) + length(p.buf) > size THEN {{'buf': p.buf, 'done': list_append(s.done, {{'t': s.buf, 'big': false}})}}
           ELSE {{'buf': s.buf || p.buf, 'done': s.done}} END, {{'buf': '', 'done': CAST([] AS STRUCT(t VARCHAR, big BOOLEAN)[])}})"""
    return f"""nodes AS (
  SELECT {key}, [0] AS ord, content AS text, chunk_size AS size, {separators('language')} AS seps, true AS again FROM {source} WHERE route = 'split'
  UNION ALL
  SELECT {key}, list_append(ord, i), item.t, size, rest, item.big AND len(rest) > 0
  FROM (SELECT {key}, ord, size, rest, unnest(items) AS item, unnest(range(len(items))) AS i
        FROM (SELECT {key}, ord, size, rest, {flush.replace('s.', 's.')} AS items
              FROM (SELECT {key}, ord, size, rest, {fold} AS s
                    FROM (SELECT *, CASE WHEN chosen = '' THEN string_split(text, '') ELSE {cut} END AS cuts
                          FROM (SELECT *, seps[pos] AS chosen, CASE WHEN seps[pos] = '' THEN [] ELSE seps[pos + 1:] END AS rest
                                FROM (SELECT *, list_position(list_transform(seps, lambda x: x = '' OR strpos(text, x) > 0), true) AS pos
                                      FROM nodes WHERE again) a) b) c) d) e) f
), cuts AS (
  SELECT {key}, ord, {S.py_strip('text')} AS c, size FROM nodes WHERE NOT again AND {S.py_strip('text')} <> ''
), alone AS (
  SELECT {key}, max(length(c)) AS longest FROM cuts GROUP BY {key} HAVING count(*) = 1
), pieces AS (
  SELECT {key}, 0 AS chunk_index, content AS c FROM {source} WHERE route = 'whole'
  UNION ALL
  SELECT cuts.{key}, CAST(row_number() OVER (PARTITION BY cuts.{key} ORDER BY ord) - 1 AS INT), c FROM cuts LEFT JOIN alone ON alone.{key} = cuts.{key}
  WHERE longest IS NULL OR longest >= size * 1.2
  UNION ALL
  SELECT s.{key}, 0, content FROM {source} s JOIN alone ON alone.{key} = s.{key} WHERE route = 'split' AND longest < chunk_size * 1.2
)"""
