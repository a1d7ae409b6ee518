"""DuckDB SQL for the llm queries that SQL can express."""

from __future__ import annotations

#: Kind, expression, group and least length of the group: the three base kinds, then the added ones.
SECRETS = (
    ("assign", r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 1, 12),
    ("access", r"AKIA[A-Z0-9]+", 0, 18),
    ("hex", r"[0-9a-f]+", 0, 16),
    ("private_key", r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----", 0, 0),
    ("git_token", r"gh[porsu]_[A-Za-z0-9]{36,}", 0, 0),
    ("chat_token", r"xox[abprs]-[A-Za-z0-9-]{10,}", 0, 0),
    ("web_token", r"eyJ[A-Za-z0-9_-]{10,}\.eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]*", 0, 0),
    ("cloud_key", r"AIza[0-9A-Za-z_-]{35}", 0, 0),
    ("pay_key", r"[rs]k_live_[0-9A-Za-z]{16,}", 0, 0),
)


def _spans(number: int, regex: str, group: int, least: int) -> str:
    """List of (start, kind, stop) from the lengths of a regular expression's matches and of the gaps between them."""
    r = "'" + regex.replace("'", "''") + "'"
    sizes = lambda x: f"coalesce(list_sum(list_transform({x}, lambda s: length(s))), 0)"
    m, g, v = f"regexp_extract_all(t, {r})", f"regexp_split_to_array(t, {r})", f"regexp_extract_all(t, {r}, {group})"
    start = f"({sizes('g[1:i]')} + {sizes('m[1:i - 1]')})::BIGINT"
    one = f"{{'start': {start}, 'kind': {number}, 'stop': ({start} + length(m[i]))::BIGINT}}"
    return f"SELECT doc_id, unnest(list_transform(list_filter(range(1, len(m) + 1), lambda i: length(v[i]) >= {least}), lambda i: {one})) AS s FROM (SELECT doc_id, {m} AS m, {g} AS g, {v} AS v FROM d) WHERE len(m) > 0"


def secret_scan() -> str:
    parts = " UNION ALL ".join(_spans(n, regex, group, least) for n, (_, regex, group, least) in enumerate(SECRETS))
    names = ", ".join(f"'{kind}'" for kind, *_ in SECRETS)
    told = lambda where: f"coalesce(string_agg([{names}][s.kind + 1] || ':' || s.start::VARCHAR || ':' || s.stop::VARCHAR, ',' ORDER BY s.start, s.kind) FILTER ({where}), '')"
    counts = ", ".join(f"count(*) FILTER (s.kind = {n}) AS n_{SECRETS[n][0]}" for n in range(3))
    return f"""WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents), x AS ({parts})
SELECT d.doc_id, {counts}, sha256({told('s.kind < 3')}) AS base_sha256, {told('s IS NOT NULL')} AS spans FROM d LEFT JOIN x USING (doc_id) GROUP BY d.doc_id"""


WARC_REVISITS = f"""WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages),
m AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS original FROM p)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN payload_bytes >= 1000 AND page_id <> original THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= 1000 AND page_id <> original THEN original END AS refers_to FROM m"""

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LINE_DEDUP = f"""WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents),
x AS (SELECT doc_id, unnest(l) AS line, unnest(range(len(l))) AS place FROM d),
k AS (SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), '{UPPER}', '{LOWER}') AS key FROM x),
f AS (SELECT key, max(doc_id) AS top FROM k WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
j AS (SELECT k.*, coalesce(f.top <> k.doc_id, false) AS gone FROM k LEFT JOIN f USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped, sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (NOT gone), '')) AS kept_sha256
FROM j GROUP BY doc_id"""

FILL_IN_MIDDLE = """WITH d AS (SELECT doc_id, coalesce(text, '') AS t, sha256('7:' || doc_id::VARCHAR) AS s FROM documents),
u AS (SELECT *, regexp_extract_all(t, '[^\\n]*\\n|[^\\n]+') AS u FROM d),
h AS (SELECT *, len(u) AS n, ('0x' || s[1:8])::UBIGINT % (len(u) + 1) AS a, ('0x' || s[9:16])::UBIGINT % (len(u) + 1) AS b, ('0x' || s[25:32])::UBIGINT % 100 AS kind FROM u),
p AS (SELECT *, coalesce(array_to_string(u[1:least(a, b)], ''), '') AS prefix, coalesce(array_to_string(u[least(a, b) + 1:greatest(a, b)], ''), '') AS middle, coalesce(array_to_string(u[greatest(a, b) + 1:], ''), '') AS suffix,
  CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') THEN 'plain' WHEN kind < 50 THEN 'spm' ELSE 'psm' END AS form FROM h)
SELECT doc_id, n::BIGINT AS n, form, CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
  sha256(prefix || middle || suffix) AS restored_sha256 FROM p"""


def centroid_clusters(k: int = 8, rounds: int = 10, dims: int = 64) -> str:
    far = f"list_sum(list_transform(range(1, {dims + 1}), lambda i: (v.x[i] - c.x[i]) * (v.x[i] - c.x[i])))::BIGINT"
    steps = ""
    for r in range(rounds + 1):
        steps += f""", a{r} AS MATERIALIZED (SELECT i, arg_min(n, (d, n)) AS n, min(d) AS d FROM (SELECT v.i, c.n, {far} AS d FROM v, c{r} c) GROUP BY i)"""
        if r < rounds:
            steps += f""", m{r} AS (SELECT n, j, (sum(x[j]) - ((sum(x[j]) % count(*)) + count(*)) % count(*)) // count(*) AS s FROM a{r} JOIN v USING (i), range(1, {dims + 1}) AS dims(j) GROUP BY n, j),
c{r + 1} AS MATERIALIZED (SELECT c.n, coalesce(m.x, c.x) AS x FROM c{r} c LEFT JOIN (SELECT n, list(s::BIGINT ORDER BY j) AS x FROM m{r} GROUP BY n) m USING (n))"""
    return f"""WITH v AS MATERIALIZED (SELECT row_number() OVER () AS i, vec_id, list_transform(embedding, lambda x: floor(x::DOUBLE * 1024)::BIGINT) AS x FROM embeddings
  WHERE len(embedding) = {dims} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {dims}),
c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY sha256('3:' || vec_id::VARCHAR)) - 1 AS n, x FROM v ORDER BY sha256('3:' || vec_id::VARCHAR) LIMIT {k}){steps}
SELECT v.vec_id, a.n::INT AS cluster, a.d AS distance, (sum(a.d) OVER (PARTITION BY a.n))::BIGINT AS cluster_inertia, (sum(a.d) OVER ())::BIGINT AS inertia, sha256(array_to_string(c.x, ',')) AS centroid_sha256
FROM a{rounds} a JOIN v USING (i) JOIN c{rounds} c ON c.n = a.n"""


ORACLES = {
    "op1_secret_scan": secret_scan(),
    "op7_warc_revisits": WARC_REVISITS,
    "op11_line_dedup": LINE_DEDUP,
    "op12_fill_in_middle": FILL_IN_MIDDLE,
    "op13_centroid_clusters": centroid_clusters(),
}
