"""The registered queries of this subpackage: name -> (query, SQL or None)."""
from __future__ import annotations

import public_tokenizers

from . import decontam, langid, licenses, linededup, minhash, ngram_join, packing, prefix_trie, text, token_files, toxicity, trie_tokens, turn_repair, vectors


def _table(spark, sf, name):
    return spark.read.parquet(f"{sf}/{name}.parquet")


def _bpe():
    return public_tokenizers.path("word_bpe_49k.json")


def op1_trie_counts(spark, sf):
    return trie_tokens.token_counts(_table(spark, sf, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op2_nearest(spark, sf):
    return vectors.nearest(_table(spark, sf, "embeddings"), "vec_id % 20 = 0", 20)


OP2_SQL = """
WITH e AS (SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings WHERE embedding IS NOT NULL AND len(embedding) > 0
             AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
     s AS (SELECT q.vec_id AS query_id, b.vec_id, list_inner_product(q.v, b.v) AS score FROM e q JOIN e b ON q.vec_id <> b.vec_id AND len(q.v) = len(b.v) WHERE q.vec_id % 20 = 0)
SELECT query_id, rank, vec_id, score FROM (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s) WHERE rank <= 20
"""


def op3_minhash(spark, sf):
    return minhash.near_duplicates(_table(spark, sf, "documents"))


def op4_token_files(spark, sf):
    path = text.work_folder(spark)
    token_files.write_token_files(_table(spark, sf, "documents"), path, _bpe(), end_id=2)
    return token_files.read_token_files(spark, path, ids=False)


def op5_licenses(spark, sf):
    return licenses.scan(_table(spark, sf, "documents"))


def op6_toxicity(spark, sf):
    return toxicity.classify(_table(spark, sf, "documents"), _table(spark, sf, "labels"))


def op7_language(spark, sf):
    return langid.identify(_table(spark, sf, "documents"))


def op8_line_dedup(spark, sf):
    return linededup.removed_runs(_table(spark, sf, "documents"))


def op9_packing(spark, sf):
    return packing.pack_documents(_table(spark, sf, "documents"), _bpe(), capacity=2048, end_id=0)


def op10_decontaminate(spark, sf):
    return decontam.find_items(_table(spark, sf, "documents"), _table(spark, sf, "benchmark"))


def _crc32(text: str) -> str:
    """DuckDB expression for the crc32 of a short ASCII text, a bit at a time."""
    byte = "list_reduce(range(8), lambda x, i: xor(x >> 1, (x & 1) * 3988292384), xor(x, c))"
    return f"xor(list_reduce([CAST(ascii(c) AS BIGINT) FOR c IN string_split({text}, '')], lambda x, c: {byte}, 4294967295::BIGINT), 4294967295)"


def op11_prefix_trie(spark, sf):
    return prefix_trie.trie(_table(spark, sf, "conversations"))


OP11_SQL = f"""
WITH t AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) - 1 AS place, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
     c AS (SELECT conv_id, conv_id - conv_id % 100 AS base, {_crc32("CAST(conv_id AS VARCHAR)")} % 6 AS h FROM (SELECT DISTINCT conv_id FROM t)),
     r AS (SELECT c.conv_id, t.place, 0 AS own, t.role, t.text FROM c JOIN t ON t.conv_id = c.base AND t.place < c.h UNION ALL SELECT c.conv_id, t.place, 1, t.role, t.text FROM c JOIN t ON t.conv_id = c.conv_id AND t.place >= c.h),
     d AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY own, place) AS depth, text, string_agg(sha256(role) || sha256(text), '' ORDER BY own, place) OVER (PARTITION BY conv_id ORDER BY own, place) AS chain FROM r),
     m AS (SELECT conv_id, depth, sha256(chain) AS node, sha256(left(chain, len(chain) - 128)) AS parent, len(text) AS size FROM d UNION ALL SELECT conv_id, 0, sha256(''), NULL, 0 FROM c),
     l AS (SELECT *, depth = max(depth) OVER (PARTITION BY conv_id) AS is_end FROM m),
     n AS (SELECT node, depth, min(conv_id) AS conv_id, any_value(parent) AS parent, count(*) AS n_convs, (count(*) - 1) * max(size) AS worth, sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE is_end), '')) AS ends_sha256 FROM l GROUP BY node, depth),
     k AS (SELECT n.*, p.conv_id AS parent_conv_id, (SELECT count(*) FROM n x WHERE x.parent = n.node AND x.depth = n.depth + 1) AS n_children FROM n LEFT JOIN n p ON p.node = n.parent AND p.depth = n.depth - 1),
     below AS (SELECT a.node, a.depth, sum(k.worth) AS saved_tokens, count(*) FILTER (WHERE k.n_children = 0) AS n_leaves FROM k JOIN m s ON s.conv_id = k.conv_id AND s.depth = k.depth JOIN m a ON a.conv_id = k.conv_id AND a.depth <= k.depth GROUP BY a.node, a.depth)
SELECT k.conv_id, k.depth, k.parent_conv_id, k.n_convs, k.n_children, CAST(b.n_leaves AS BIGINT) AS n_leaves, CAST(b.saved_tokens AS BIGINT) AS saved_tokens, k.ends_sha256 FROM k JOIN below b ON b.node = k.node AND b.depth = k.depth
"""


def op12_ngram_join(spark, sf):
    return ngram_join.jaccard_components(_table(spark, sf, "documents"))


OP12_SQL = """
WITH RECURSIVE w AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words FROM documents),
     s AS (SELECT doc_id, list_distinct(CASE WHEN len(words) = 0 THEN [] WHEN len(words) < 3 THEN [array_to_string(words, ' ')]
             ELSE list_transform(range(1, CAST(len(words) - 1 AS BIGINT)), lambda i: words[i] || ' ' || words[i + 1] || ' ' || words[i + 2]) END) AS grams FROM w),
     e AS MATERIALIZED (SELECT doc_id, len(grams) AS n, unnest(grams) AS gram FROM s),
     p AS MATERIALIZED (SELECT a.doc_id AS x, b.doc_id AS y FROM e a JOIN e b ON a.gram = b.gram AND a.doc_id < b.doc_id AND 100 * least(a.n, b.n) >= 90 * greatest(a.n, b.n)
             GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 90 * (a.n + b.n - count(*))),
     both_ways AS (SELECT x, y FROM p UNION SELECT y, x FROM p),
     reach AS (SELECT x AS doc_id, y AS seen FROM both_ways UNION SELECT r.doc_id, b.y FROM reach r JOIN both_ways b ON b.x = r.seen)
SELECT s.doc_id, CAST(len(s.grams) AS BIGINT) AS n_shingles, least(s.doc_id, coalesce(m.low, s.doc_id)) AS component_id FROM s LEFT JOIN (SELECT doc_id, min(seen) AS low FROM reach GROUP BY doc_id) m ON m.doc_id = s.doc_id
"""


def op13_repair(spark, sf):
    return turn_repair.repair(turn_repair.damage(_table(spark, sf, "conversations")))


def _op13_sql() -> str:
    """States 0 nothing, 1 system, 2 user last, 3 assistant last hold (cost, audit, repaired lines); each turn moves all four, insertions come before it."""
    def move(state, cost, letter, line):
        sep = f"CASE WHEN {state}.t = '' THEN '' ELSE chr(10) END"
        text = f"{state}.t" if line is None else f"{state}.t || {sep} || {line}"
        return f"{{'c': {state}.c + {cost}, 'a': {state}.a || '{letter}', 't': {text}}}"

    def best(options):
        return f"list_min([{', '.join(options)}])"

    def inserted(s):
        return {"z0": f"{s}0", "z1": f"{s}1", "z2": best([f"{s}2", move(f"{s}0", 5, "I", "'user:'"), move(f"{s}1", 5, "I", "'user:'"), move(f"{s}3", 5, "I", "'user:'")]),
                "z3": best([f"{s}3", move(f"{s}2", 5, "I", "'assistant:'")])}

    extra, own = "5 * d.torn", "d.role || ':' || d.text"
    barred = "CASE WHEN d.gone THEN 1000000000 ELSE 0 END"

    def kept(state, initial):
        return move(state, f"CASE WHEN d.initial = '{initial}' THEN {extra} ELSE 1000000000 END + {barred}", "K", own)

    def retyped(state, due):
        return move(state, f"1 + {extra} + {barred} + CASE WHEN d.initial = '{due[0]}' THEN 1000000000 ELSE 0 END", "R", f"'{due}:' || d.text")

    gone = {i: move(f"i.z{i}", 2, "D", None) for i in range(4)}
    to_user = [o for q in (0, 1, 3) for o in (kept(f"i.z{q}", "u"), retyped(f"i.z{q}", "user"))]
    after = [gone[0], best([gone[1], kept("i.z0", "s")]), best([gone[2], *to_user]), best([gone[3], kept("i.z2", "a"), retyped("i.z2", "assistant")])]
    start = "{'c': 0::BIGINT, 'a': '', 't': ''}"
    never = "{'c': 1000000000000::BIGINT, 'a': '', 't': ''}"
    ins = ", ".join(f"{e} AS {n}" for n, e in inserted("s").items())
    end = best(["s0", "s3", move("s2", 5, "I", "'assistant:'")])
    key = "coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ')"
    return f"""
WITH RECURSIVE k AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, {_crc32(key)} % 20 AS kind FROM conversations),
     g AS (SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role, CASE WHEN kind = 1 THEN '' WHEN kind = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text, unnest(range(CASE WHEN kind = 3 THEN 2 ELSE 1 END)) AS copy FROM k WHERE kind <> 0),
     o AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i FROM g),
     q AS (SELECT conv_id, turn, i, role, text, left(role, 1) AS initial, rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS bare, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS again, lead(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS following FROM o),
     d AS MATERIALIZED (SELECT *, bare = '' AS blank, bare <> '' AND again AS duplicate, bare = '' OR again AS gone, CASE WHEN bare <> '' AND NOT again AND right(bare, 1) NOT IN ('.', '!', '?') THEN 1 ELSE 0 END AS torn FROM q),
     walk AS (SELECT conv_id, 0::BIGINT AS i, {start} AS s0, {never} AS s1, {never} AS s2, {never} AS s3 FROM (SELECT DISTINCT conv_id FROM conversations)
         UNION ALL SELECT i.conv_id, d.i, {after[0]}, {after[1]}, {after[2]}, {after[3]} FROM (SELECT conv_id, i, {ins} FROM walk) i JOIN d ON d.conv_id = i.conv_id AND d.i = i.i + 1),
     fin AS (SELECT conv_id, {end} AS f FROM (SELECT conv_id, max_by(s0, i) AS s0, max_by(s2, i) AS s2, max_by(s3, i) AS s3 FROM walk GROUP BY conv_id)),
     counts AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (WHERE blank) AS blank, count(*) FILTER (WHERE duplicate) AS duplicate, sum(torn) AS truncated,
                count(*) FILTER (WHERE following IS NOT NULL AND initial || following NOT IN ('su', 'ua', 'au')) AS illegal FROM d GROUP BY conv_id)
SELECT fin.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, CAST(coalesce(blank, 0) AS BIGINT) AS blank, CAST(coalesce(duplicate, 0) AS BIGINT) AS duplicate, CAST(coalesce(truncated, 0) AS BIGINT) AS truncated,
       CAST(coalesce(illegal, 0) AS BIGINT) AS illegal, f.c AS cost, f.a AS audit, sha256(f.t) AS repaired_sha256 FROM fin LEFT JOIN counts USING (conv_id)
"""


QUERIES = {
    "op1_trie_counts": (op1_trie_counts, None),
    "op2_nearest": (op2_nearest, OP2_SQL),
    "op3_minhash": (op3_minhash, None),
    "op4_token_files": (op4_token_files, None),
    "op5_licenses": (op5_licenses, None),
    "op6_toxicity": (op6_toxicity, None),
    "op7_language": (op7_language, None),
    "op8_line_dedup": (op8_line_dedup, None),
    "op9_packing": (op9_packing, None),
    "op10_decontaminate": (op10_decontaminate, None),
    "op11_prefix_trie": (op11_prefix_trie, OP11_SQL),
    "op12_ngram_join": (op12_ngram_join, OP12_SQL),
    "op13_repair": (op13_repair, _op13_sql()),
}
