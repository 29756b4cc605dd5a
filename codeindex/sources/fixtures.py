"""Portable fixture views over the given tables (same SQL text in Spark and DuckDB).

Each view reshapes the driver tables into a record the engine consumes
(requests, archive entries, payloads). ``fixture(spark, sf_dir, name)`` returns
the Spark DataFrame; ``cte(*names)`` renders the same SQL as a WITH clause for
the DuckDB oracle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..session import register_tables

FIXTURE_SQL: dict[str, str] = {
    "fx_repo_requests": """
SELECT repository_id,
       concat('org', CAST(repository_id % 5 AS STRING)) AS owner,
       concat('repo-', CAST(repository_id AS STRING), '.x') AS repo_name,
       CASE WHEN second THEN 'release' WHEN repository_id % 3 = 0 THEN 'main' WHEN repository_id % 3 = 1 THEN 'feature/a-b' ELSE 'dev' END AS branch
FROM (SELECT DISTINCT CAST(substr(source, 4) AS BIGINT) AS repository_id, false AS second FROM documents
      UNION ALL
      SELECT DISTINCT CAST(substr(source, 4) AS BIGINT) AS repository_id, true AS second FROM documents
      WHERE CAST(substr(source, 4) AS BIGINT) % 4 = 0) t
""",
    "fx_archive_entries": """
SELECT doc_id, CAST(substr(source, 4) AS BIGINT) AS repository_id,
       CASE WHEN doc_id % 31 = 0 THEN concat('top', CAST(doc_id AS STRING), '.py')
            WHEN doc_id % 29 = 0 THEN concat('repo-abc/dir', CAST(doc_id AS STRING), '/')
            WHEN doc_id % 17 = 0 THEN concat('repo-abc/.github/w', CAST(doc_id AS STRING), '.yml')
            ELSE concat('repo-abc/src/d', CAST(doc_id AS STRING), '/',
              CASE doc_id % 14 WHEN 0 THEN 'a.py' WHEN 1 THEN 'B.java' WHEN 2 THEN 'c.ts'
                WHEN 3 THEN 'd.go' WHEN 4 THEN 'e.rs' WHEN 5 THEN 'f.C' WHEN 6 THEN 'g.hpp'
                WHEN 7 THEN 'Makefile' WHEN 8 THEN 'dockerfile' WHEN 9 THEN 'h.tar.SQL'
                WHEN 10 THEN 'i.kt' WHEN 11 THEN 'j.bin' WHEN 12 THEN 'k.d.ts' ELSE 'README' END) END AS entry,
       CASE WHEN doc_id % 19 = 0 THEN concat(' ', chr(9), chr(10)) ELSE text END AS content,
       CASE WHEN r % 4 = 0 AND doc_id % 3 = 0 THEN 'release' WHEN r % 3 = 0 THEN 'main' WHEN r % 3 = 1 THEN 'feature/a-b' ELSE 'dev' END AS branch
FROM (SELECT *, CAST(substr(source, 4) AS BIGINT) AS r FROM documents) t
""",
    "fx_code_files": """
SELECT doc_id, CAST(substr(source, 4) AS BIGINT) AS repository_id,
       concat('src/m', CAST(doc_id AS STRING), CASE k WHEN 0 THEN '.py' WHEN 1 THEN '.ts'
         WHEN 2 THEN '.kt' WHEN 3 THEN '.go' WHEN 4 THEN '.rs' WHEN 5 THEN '.cpp' ELSE '.rb' END) AS file_path,
       CASE k WHEN 0 THEN 'python' WHEN 1 THEN 'typescript' WHEN 2 THEN 'kotlin' WHEN 3 THEN 'go'
         WHEN 4 THEN 'rust' WHEN 5 THEN 'cpp' ELSE 'ruby' END AS language,
       concat(CASE k
         WHEN 0 THEN concat('class C', n, ':', nl, '    pass', nl, 'async def f', n, '(x):', nl)
         WHEN 1 THEN concat('export class C', n, ' {}', nl, 'export async function f', n, '() {}', nl)
         WHEN 2 THEN concat('public final class C', n, ' {', nl, '  private fun f', n, '() {}', nl, '}', nl)
         WHEN 3 THEN concat('func (r *T', n, ') f', n, '() {}', nl)
         WHEN 4 THEN concat('pub struct C', n, ';', nl, 'pub fn f', n, '() {}', nl)
         WHEN 5 THEN concat('struct C', n, ' {};', nl, 'static int f', n, '(int a) {', nl, '}', nl)
         ELSE concat('class C', n, nl, 'def f', n, nl) END, '# ', text) AS content,
       CASE WHEN k IN (3, 6) THEN NULL ELSE concat('C', n) END AS want_class,
       CASE WHEN k = 6 THEN NULL ELSE concat('f', n) END AS want_func
FROM (SELECT *, doc_id % 7 AS k, CAST(doc_id AS STRING) AS n, chr(10) AS nl FROM documents) t
""",
    "fx_split_files": """
SELECT p_partkey AS file_id, 2 + p_partkey % 4 AS n_blocks,
       CASE WHEN p_partkey % 2 = 0 THEN 'go' ELSE 'text' END AS language,
       concat('src/s', n, CASE WHEN p_partkey % 2 = 0 THEN '.go' ELSE '.txt' END) AS file_path,
       concat(lead, n, 'a', fill) AS b0, concat(lead, n, 'b', fill) AS b1, concat(lead, n, 'c', fill) AS b2,
       concat(lead, n, 'd', fill) AS b3, concat(lead, n, 'e', fill) AS b4
FROM (SELECT *, CAST(p_partkey AS STRING) AS n, concat('() { ', repeat('step; ', 140), '}') AS fill,
             CASE WHEN p_partkey % 2 = 0 THEN concat(chr(10), 'func f') ELSE concat(chr(10), chr(10), 'para f') END AS lead FROM part) t
""",
    "fx_java_files": """
SELECT p_partkey AS file_id, concat('src/P', n, '.java') AS file_path,
       concat('package p;', nl, nl, 'public class P', n, ' {', nl, '  private int size = ', CAST(p_size AS STRING), ';', nl) AS p_head,
       concat('  public int a', n, '() {', nl, '    String s = "}";', nl, '    return 1;', nl, '  }') AS p_m1,
       concat(nl, nl, '  // about b {', nl, '  private static void b', n, '(int x) {', nl, '    if (x > 0) { x -= 1; }', nl, '  }') AS p_m2,
       concat(nl, '  int tail', n, ';', nl, '}', nl) AS p_tail
FROM (SELECT *, CAST(p_partkey AS STRING) AS n, chr(10) AS nl FROM part) t
""",
    "fx_pulls": """
SELECT CAST(floor(o_orderkey / 20) AS BIGINT) AS pr_number, CAST(o_orderkey % 20 AS BIGINT) AS repository_id,
       CASE WHEN o_orderkey % 43 = 0 THEN NULL ELSE concat('Change ', n, ' ', o_orderpriority) END AS title,
       CASE WHEN o_orderkey % 4 = 0 THEN NULL WHEN o_orderkey % 4 = 1 THEN '  ' ELSE concat(' body ', n, ' ') END AS body,
       CASE WHEN o_orderkey % 37 = 0 THEN NULL WHEN o_orderkey % 41 = 0 THEN 'draft'
            WHEN o_orderstatus = 'O' THEN 'open' ELSE 'closed' END AS state,
       concat(substr(CAST(o_orderdate AS STRING), 1, 10), 'T12:00:00Z') AS created_at,
       CASE WHEN o_orderstatus = 'O' THEN NULL WHEN o_orderkey % 11 = 0 THEN 'not-a-date'
            ELSE concat(substr(CAST(o_orderdate AS STRING), 1, 10), 'T18:30:00+09:00') END AS closed_at,
       concat('{"user":{"login":"u', CAST(o_custkey AS STRING), '"},"labels":[',
         CASE WHEN o_orderkey % 3 = 0 THEN '' ELSE concat('{"name":"', o_orderpriority, '"},{"name":"x"}') END,
         '],"milestone":', CASE WHEN o_orderkey % 5 = 0 THEN 'null' ELSE concat('{"title":"m', CAST(o_orderkey % 5 AS STRING), '"}') END, '}') AS payload
FROM (SELECT *, CAST(o_orderkey AS STRING) AS n FROM orders) t
""",
    "fx_pull_files": """
SELECT CAST(l_orderkey % 20 AS BIGINT) AS repository_id, CAST(floor(l_orderkey / 20) AS BIGINT) AS pr_number,
       CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS BIGINT) AS position,
       concat('src/p', CAST(l_partkey AS STRING), '.py') AS filename,
       CAST(floor(l_quantity) AS BIGINT) AS additions,
       CAST(floor(l_tax * 100 + 0.5) AS BIGINT) AS deletions
FROM lineitem
""",
    "fx_pull_commits": """
SELECT CAST(conv_id % 20 AS BIGINT) AS repository_id, CAST(floor(conv_id / 20) AS BIGINT) AS pr_number, turn AS position,
       CASE WHEN (conv_id + turn) % 6 = 0 THEN '   ' ELSE concat(' ', text, ' ') END AS message
FROM conversations
""",
    "fx_index_batches": """
SELECT 1 AS batch_no, doc_id AS id, text, lang AS language, source FROM documents
UNION ALL
SELECT 2 AS batch_no, doc_id AS id, concat('v2 ', text) AS text, lang AS language, source FROM documents WHERE doc_id % 7 = 0
UNION ALL
SELECT 2 AS batch_no, doc_id + 1000000 AS id, text, lang AS language, source FROM documents WHERE doc_id % 50 = 0
""",
    "fx_search_queries": """
SELECT item_id AS query_id, lower(text) AS q, item_id AS query_vec_id
FROM benchmark
""",
    "fx_pr_request_log": """
SELECT event_id AS request_id, ts AS requested_at, CAST(k % 20 AS BIGINT) AS repository_id,
       concat('org', CAST(k % 5 AS STRING)) AS owner,
       concat('repo-', CAST(k % 20 AS STRING), '.x') AS repo_name,
       'main' AS branch, CASE WHEN event_id % 10 = 0 THEN 900000000 + event_id ELSE CAST(floor(k / 20) AS BIGINT) END AS pr_number
FROM (SELECT *, (event_id * 7919) % (SELECT max(o_orderkey) + 1 FROM orders) AS k FROM events) t
""",
    "fx_tree_items": """
SELECT doc_id, CAST(substr(source, 4) AS BIGINT) AS repository_id,
       concat('{"path":"src/d', CAST(doc_id AS STRING), CASE WHEN doc_id % 9 = 0 THEN '' WHEN doc_id % 5 = 0 THEN '/x.bin' ELSE '/x.py' END,
              '","type":"', CASE WHEN doc_id % 9 = 0 THEN 'tree' ELSE 'blob' END,
              '","url":"u', CAST(doc_id AS STRING), '"}') AS item_json,
       concat('u', CAST(doc_id AS STRING)) AS url,
       CASE WHEN doc_id % 9 = 0 OR doc_id % 23 = 0 THEN NULL ELSE text END AS blob_text,
       CASE WHEN doc_id % 47 = 0 THEN 'base64' WHEN doc_id % 53 = 0 THEN 'utf8' END AS fault
FROM documents
""",
    "fx_archives": """
SELECT repository_id, CASE WHEN repository_id % 6 = 0 THEN NULL ELSE n_bytes END AS n_bytes
FROM (SELECT CAST(substr(source, 4) AS BIGINT) AS repository_id, CAST(sum(length(text)) AS BIGINT) AS n_bytes
      FROM documents GROUP BY CAST(substr(source, 4) AS BIGINT)) t
""",
}


def fixture(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The fixture as a DataFrame bound to the tables under ``sf_dir``."""
    register_tables(spark, sf_dir)
    return spark.sql(FIXTURE_SQL[name])


def cte(*names: str) -> str:
    """``WITH a AS (...), b AS (...)`` for the oracle (DuckDB)."""
    return "WITH " + ",\n".join(f"{n} AS ({FIXTURE_SQL[n]})" for n in names) + "\n"
