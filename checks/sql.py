"""DuckDB SQL for the queries in ``checks.queries``; same column names, same values."""

from __future__ import annotations

# For the two trainings that are timed, and for all queries that need a tokenizer.
VOCAB_SIZE, LARGE_VOCAB_SIZE = 300, 2_000
CHAR_WORD = r"[!-/:-@\[-`{-~\p{P}]|[^\s!-/:-@\[-`{-~\p{P}]+"
BYTE_WORD = (
    r"''s|''t|''re|''ve|''m|''ll|''d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}\x{E000}]+|\s+"
)
SPACES = (
    "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || chr(28) || chr(29) || chr(30)"
    " || chr(31) || chr(133) || chr(160) || chr(5760) || chr(8192) || chr(8193) || chr(8194)"
    " || chr(8195) || chr(8196) || chr(8197) || chr(8198) || chr(8199) || chr(8200) || chr(8201)"
    " || chr(8202) || chr(8232) || chr(8233) || chr(8239) || chr(8287) || chr(12288)"
)


def _text(ids: str) -> str:
    return f"coalesce(array_to_string({ids}, ' '), '')"


def split_cte(table: str = "documents", key: str = "doc_id", name: str = "split_docs") -> str:
    keys = [k.strip() for k in key.split(",")]
    hashed = "md5('123' || " + " || ".join(f"'|' || {k}" for k in keys) + ")"
    return f"""{name} AS (
      SELECT *, CASE WHEN row_number() OVER (ORDER BY {hashed}, {key})
                       <= (SELECT ceil(count(*) * 0.2::DOUBLE) FROM {table})
                     THEN 'validation' ELSE 'train' END AS split
      FROM {table})"""


PREPARED = (
    split_cte()
    + """,
    prepared AS (
      SELECT * EXCLUDE (place) FROM (
        SELECT *, row_number() OVER (PARTITION BY split ORDER BY md5('123|' || doc_id), doc_id) AS place
        FROM split_docs WHERE length(text) < 1500)
      WHERE place <= CASE split WHEN 'train' THEN 300 ELSE 80 END)"""
)

STAND_IN = f"""stand_in AS (
      SELECT *, list_transform(regexp_extract_all(text, '{CHAR_WORD}'), lambda w: length(w)) AS raw_ids
      FROM split_docs)"""

SEQUENCES = """sequences AS (
      SELECT *, raw_ids AS input_ids, list_append(raw_ids, 2) AS ids,
             list_append(raw_ids, 2)[2:] AS output_ids
      FROM stand_in)"""

WITH_SEQUENCES = f"WITH {split_cte()}, {STAND_IN}, {SEQUENCES}"

BATCHES = f"""{WITH_SEQUENCES},
    ranked AS (
      SELECT *, (row_number() OVER (PARTITION BY split ORDER BY md5('123|0|' || doc_id), doc_id) - 1) // 32
                AS batch_id
      FROM sequences),
    wide AS (SELECT *, max(len(input_ids)) OVER (PARTITION BY split, batch_id) AS width FROM ranked)
    SELECT split, batch_id, doc_id,
      {_text('''list_concat(input_ids, CASE WHEN len(input_ids) < width THEN [2] ELSE [] END,
        list_transform(range(greatest(width - len(input_ids) - 1, 0)), lambda i: 0))''')} AS x,
      {_text('''list_concat(output_ids,
        list_transform(range(greatest(width - len(output_ids), 0)), lambda i: 0))''')} AS y
    FROM wide"""

BYTES = """byte_names AS (
      SELECT printf('%02X', b) AS hex,
             chr((CASE WHEN stays THEN b ELSE 255 + row_number() OVER (PARTITION BY stays ORDER BY b) END)::INT)
               AS shown
      FROM (SELECT b, b BETWEEN 33 AND 126 OR b BETWEEN 161 AND 172 OR b BETWEEN 174 AND 255 AS stays
            FROM range(256) t(b)))"""


def _spaced(text: str) -> str:
    return f"CASE WHEN {text} LIKE ' %' OR {text} = '' THEN {text} ELSE ' ' || {text} END"


def _byte_words(text: str) -> str:
    marked = f"regexp_replace({text}, '(\\s+)(\\s\\S)', '\\1' || chr(57344) || '\\2', 'g')"
    return f"regexp_extract_all({marked}, '{BYTE_WORD}')"


def words_sql(kind: str, source: str, training: bool) -> str:
    """Rows ``(doc_id, words)`` of a source with ``doc_id`` and ``text``."""
    if kind == "char":
        return f"SELECT doc_id, regexp_extract_all(text, '{CHAR_WORD}') AS words FROM {source}"
    if not training:
        return f"SELECT doc_id, {_byte_words(_spaced('text'))} AS words FROM {source}"
    line = "CASE WHEN line LIKE ' %' THEN line ELSE ' ' || line END || chr(10)"
    return f"""SELECT doc_id, {_byte_words('spaced')} AS words FROM (
        SELECT doc_id, {line} AS spaced
        FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM {source}))"""


def counts_cte(kind: str, source: str = "documents", training: bool = True, tag: str = "") -> str:
    """Word counts, and each word's letters in order: ``letters(word, n, pos, letter, token)``."""
    counts = f"""counts{tag} AS (
      SELECT word, count(*) AS n
      FROM (SELECT unnest(words) AS word FROM ({words_sql(kind, source, training)})) GROUP BY word)"""
    if kind == "char":
        return f"""{counts},
    letters{tag} AS (
      SELECT word, n, pos, letter, CASE WHEN pos = length(word) THEN letter || '</w>' ELSE letter END AS token
      FROM (SELECT word, n, unnest(string_split(word, '')) AS letter,
                   unnest(range(1, length(word) + 1)) AS pos FROM counts{tag}))"""
    return f"""{BYTES if not tag else BYTES.replace('byte_names', 'byte_names' + tag)},
    {counts},
    letters{tag} AS (
      SELECT word, n, pos, shown AS letter, shown AS token
      FROM (SELECT word, n, substr(hex(encode(word)), 2 * i + 1, 2) AS hex, i + 1 AS pos
            FROM (SELECT word, n, unnest(range(octet_length(encode(word)))) AS i FROM counts{tag})) h
      JOIN byte_names{tag} USING (hex))"""


def training_cte(kind: str, source: str = "documents", size: int = LARGE_VOCAB_SIZE) -> str:
    """``train``: words ('w'), vocabulary ('v') and merges ('m') after each round.

    A symbol is the character with code point ``id + 1``.
    """
    return f"""{counts_cte(kind, source)},
    base AS (
      SELECT token, row_number() OVER (ORDER BY part, token) - 1 AS id FROM (
        SELECT unnest([1, 2, 3, 4]) AS part,
               unnest(['<|pad|>', '<|start_of_text|>', '<|end_of_text|>', '<|unk|>']) AS token
        UNION ALL SELECT DISTINCT 5, letter FROM letters
        UNION ALL SELECT DISTINCT 6, token FROM letters WHERE token <> letter)),
    spelled AS (
      SELECT string_agg(chr((b.id + 1)::INT), '' ORDER BY pos) AS s, any_value(n) AS n
      FROM letters l JOIN base b ON b.token = l.token GROUP BY word),
    train AS (
      SELECT 0 AS round, 'w' AS kind, s, NULL::VARCHAR AS a, NULL::VARCHAR AS b, n FROM spelled
      UNION ALL SELECT 0, 'v', chr((id + 1)::INT), token, NULL, NULL FROM base
      UNION ALL (
        WITH prev AS (SELECT * FROM train WHERE kind <> 'm'),
        size AS (SELECT count(*) AS v, max(round) AS round FROM prev WHERE kind = 'v'),
        pairs AS (
          SELECT s[i:i+1] AS pair, sum(n) AS n
          FROM (SELECT s, n, unnest(range(1, length(s))) AS i FROM prev WHERE kind = 'w' AND length(s) > 1)
          GROUP BY 1),
        best AS (
          SELECT pair, n FROM pairs WHERE n >= 2 AND (SELECT v FROM size) < {size}
          ORDER BY n DESC, pair LIMIT 1),
        named AS (
          SELECT pair, best.n, l.a AS l, r.a AS r, l.a || r.a AS token
          FROM best JOIN prev l ON l.kind = 'v' AND l.s = pair[1] JOIN prev r ON r.kind = 'v' AND r.s = pair[2]),
        made AS (
          SELECT named.*, coalesce((SELECT s FROM prev WHERE kind = 'v' AND a = token),
                                   chr(((SELECT v FROM size) + 1)::INT)) AS symbol
          FROM named)
        SELECT prev.round + 1, prev.kind,
               CASE WHEN prev.kind = 'w' THEN replace(prev.s, pair, symbol) ELSE prev.s END,
               prev.a, prev.b, prev.n
        FROM prev, made
        UNION ALL
        SELECT (SELECT round FROM size) + 1, 'v', symbol, token, NULL, NULL FROM made
        WHERE NOT EXISTS (SELECT 1 FROM prev WHERE kind = 'v' AND a = token)
        UNION ALL
        SELECT (SELECT round FROM size) + 1, 'm', token, l, r, n::BIGINT FROM made)),
    merges AS (SELECT round - 1 AS rank, a AS l, b AS r, s AS token FROM train WHERE kind = 'm'),
    vocab AS (
      SELECT a AS token, unicode(s) - 1 AS id, unicode(s) <= 4 AS is_special
      FROM train WHERE kind = 'v' AND round = (SELECT max(round) FROM train))"""


def encoded_cte(kind: str, source: str = "documents", key: str = "doc_id") -> str:
    """``encoded(doc_id, raw_ids)``: merges applied in order to each word; unseen letters are 3."""
    return f"""{counts_cte(kind, source, training=False, tag='_e')},
    steps AS (
      SELECT list({{'pair': chr((vl.id + 1)::INT) || chr((vr.id + 1)::INT), 'symbol': chr((vt.id + 1)::INT)}}
                  ORDER BY rank) AS steps
      FROM merges m JOIN vocab vl ON vl.token = m.l JOIN vocab vr ON vr.token = m.r
      JOIN vocab vt ON vt.token = m.token),
    dictionary AS (
      SELECT word, list_transform(string_split(list_reduce(steps.steps,
               lambda w, step: replace(w, step.pair, step.symbol), s), ''), lambda c: unicode(c) - 1) AS ids
      FROM (SELECT word, string_agg(chr((coalesce(v.id, 3) + 1)::INT), '' ORDER BY pos) AS s
            FROM letters_e l LEFT JOIN vocab v ON v.token = l.token GROUP BY word), steps),
    placed AS (
      SELECT doc_id, unnest(words) AS word, unnest(range(len(words))) AS pos
      FROM ({words_sql(kind, source, False)})),
    encoded AS (
      SELECT d.doc_id, coalesce(flatten(list(ids ORDER BY pos) FILTER (ids IS NOT NULL)), []) AS raw_ids
      FROM {source} d LEFT JOIN (placed JOIN dictionary USING (word)) p ON p.doc_id = d.doc_id
      GROUP BY d.doc_id)"""


def trained(kind: str, source: str = "documents", size: int = LARGE_VOCAB_SIZE) -> str:
    return f"WITH RECURSIVE {training_cte(kind, source, size)}"


def encoded(kind: str, source: str = "documents") -> str:
    return f"{trained(kind)}, {encoded_cte(kind, source)}"


MERGES = "SELECT rank, l AS \"left\", r AS \"right\", token AS new_token FROM merges"
ENCODED = f"SELECT doc_id, {_text('raw_ids')} AS raw_ids FROM encoded"
DECODED_CHAR = f"coalesce(array_to_string(regexp_extract_all(text, '{CHAR_WORD}'), ' '), '')"


def round_trip_sql(decoded: str) -> str:
    return f"""WITH {split_cte()},
    checked AS (SELECT split, trim({decoded}, {SPACES}) = text AS same FROM split_docs)
    SELECT split, count(*) AS n_texts, count(*) FILTER (same) AS n_same,
           round(count(*) FILTER (same) / count(*), 6) AS share_same
    FROM checked GROUP BY split"""


EVALUATION = """
    SELECT split, round(sum(len(raw_ids)) / count(*), 6) AS avg_tokens_per_sentence,
           round(sum(length(text)) / count(*), 6) AS avg_chars_per_sentence,
           round(CASE WHEN sum(len(raw_ids)) > 0 THEN sum(length(text)) / sum(len(raw_ids)) ELSE 0 END, 6)
             AS compression_ratio
    FROM {table} GROUP BY split"""

SCORES = """WITH scores AS (
      SELECT vec_id, label, unnest(embedding)::DOUBLE / {t}::DOUBLE AS score,
             unnest(range(len(embedding)))::INT AS token_id FROM embeddings),
    top AS (SELECT *, max(score) OVER (PARTITION BY vec_id) AS best FROM scores),
    soft AS (SELECT *, exp(score - best) / sum(exp(score - best)) OVER (PARTITION BY vec_id) AS prob FROM top)"""

TOP_K = (
    SCORES
    + """,
    ranked AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY score DESC, token_id) AS place FROM soft),
    kept AS (
      SELECT vec_id, token_id, score, exp(score - best) / sum(exp(score - best)) OVER (PARTITION BY vec_id) AS prob
      FROM ranked WHERE place <= {k})"""
)

TOP_P = (
    SCORES
    + """,
    walked AS (
      SELECT *, coalesce(sum(prob) OVER (PARTITION BY vec_id ORDER BY score DESC, token_id
                         ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM soft),
    kept AS (
      SELECT vec_id, token_id, score, exp(score - best) / sum(exp(score - best)) OVER (PARTITION BY vec_id) AS prob
      FROM walked WHERE before <= {p})"""
)

DRAW = (
    TOP_P
    + """,
    running AS (
      SELECT *, sum(prob) OVER (PARTITION BY vec_id ORDER BY score DESC, token_id
                ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS mass,
             row_number() OVER (PARTITION BY vec_id ORDER BY score DESC, token_id) AS place,
             ('0x' || substr(md5('123|' || vec_id), 1, 13))::BIGINT / 4503599627370496.0::DOUBLE AS u FROM kept)
    SELECT vec_id, coalesce(arg_min(token_id, place) FILTER (mass >= u), arg_max(token_id, place)) AS token_id
    FROM running GROUP BY vec_id"""
)

LOG = """WITH log AS (
      SELECT event_type AS run, day(ts)::INT AS epoch,
             CASE WHEN user_id % 5 = 0 THEN 'validation' ELSE 'train' END AS split,
             event_id AS batch_num, value AS loss FROM events)"""


def oracle() -> dict[str, str]:
    sql = _oracle()
    # Other forms of operators that are there already give the same rows.
    same = {"softmax_long": "softmax_scores", "topk_long": "topk_candidates", "topp_long": "topp_candidates", "draw_long": "seeded_draw",
            "cross_entropy_long": "cross_entropy", "user_filter_columns": "filter_length", "user_map_batches": "batches_padded", "running_loss_stream": "running_loss",
            "decode_pieces": "decode", "decode_pieces_byte": "decode_byte"}
    return sql | {name: sql[other] for name, other in same.items()}


def _oracle() -> dict[str, str]:
    held_out = "(SELECT item_id AS doc_id, text FROM benchmark)"
    byte_decoded = "CASE WHEN text LIKE ' %' OR text = '' THEN text ELSE ' ' || text END"
    return {
        "split_counts": f"""WITH {split_cte()}
            SELECT split, count(*) AS n_rows, count(*) FILTER (text IS NULL) AS n_null,
                   count(*) FILTER (length(text) < 1500) AS n_kept FROM split_docs GROUP BY split""",
        "filter_length": "SELECT doc_id, text FROM documents WHERE length(text) < 1500",
        "split_exact": f"WITH {split_cte()} SELECT doc_id, split FROM split_docs",
        "split_conversations": f"""WITH {split_cte('conversations', 'conv_id, turn')}
            SELECT conv_id, turn, split FROM split_docs""",
        "sample_capped": f"WITH {PREPARED} SELECT split, doc_id FROM prepared",
        "split_counts_capped": f"""WITH {split_cte()}
            SELECT split, count(*) AS n_rows, count(*) FILTER (text IS NULL) AS n_null,
                   count(*) FILTER (length(text) < 1500) AS n_kept,
                   least(count(*) FILTER (length(text) < 1500), CASE split WHEN 'train' THEN 300 ELSE 80 END) AS n_capped
            FROM split_docs GROUP BY split""",
        "quick_sample": f"""WITH {split_cte()}
            SELECT split, doc_id FROM (
              SELECT *, row_number() OVER (PARTITION BY split ORDER BY md5('123|' || doc_id), doc_id) AS place
              FROM split_docs) WHERE place <= CASE split WHEN 'train' THEN 10 ELSE 2 END""",
        "random_example": f"""WITH {split_cte()}
            SELECT doc_id, text FROM split_docs WHERE split = 'train'
            ORDER BY md5('7|' || doc_id), doc_id LIMIT 1""",
        "model_sequences": f"""{WITH_SEQUENCES}
            SELECT split, doc_id, {_text('input_ids')} AS input_ids, {_text('output_ids')} AS output_ids
            FROM sequences""",
        "batches_padded": BATCHES,
        "batches_entered": f"{BATCHES} WHERE split = 'train' AND batch_id >= 1",
        "split_appended": f"""WITH loads AS (
              SELECT *, (doc_id % 3 + 1)::INT AS added,
                     row_number() OVER (PARTITION BY doc_id % 3 ORDER BY md5('123|' || doc_id), doc_id) AS place
              FROM documents),
            sizes AS (SELECT added, sum(count(*)) OVER (ORDER BY added) AS so_far FROM loads GROUP BY added),
            quotas AS (
              SELECT added, ceil(so_far * 0.2::DOUBLE)
                            - coalesce(lag(ceil(so_far * 0.2::DOUBLE)) OVER (ORDER BY added), 0) AS quota FROM sizes)
            SELECT doc_id, added, CASE WHEN place <= quota THEN 'validation' ELSE 'train' END AS split,
                   {DECODED_CHAR} AS decoded
            FROM loads JOIN quotas USING (added)""",
        "json_lines": """
            SELECT doc_id, lang, text, NULL AS raw FROM documents WHERE doc_id % 7 <> 0 AND doc_id % 11 <> 0
            UNION ALL
            SELECT NULL, NULL, NULL, CASE WHEN doc_id % 7 = 0 THEN '{"doc_id":' || doc_id || ',"te'
                                          ELSE '{"doc_id":"x' || doc_id || '"}' END
            FROM documents WHERE doc_id % 7 = 0 OR doc_id % 11 = 0""",
        "batch_counts": f"""WITH {split_cte()}
            SELECT split, ceil(count(*) / 32)::BIGINT AS n_batches FROM split_docs GROUP BY split""",
        "token_budget": f"""{WITH_SEQUENCES},
            total AS (SELECT sum(len(ids))::BIGINT AS t FROM sequences WHERE split = 'train')
            SELECT t AS total_tokens, t * 3 AS budget_tokens, round(t * 3 / 1e6::DOUBLE, 6) AS budget_millions,
                   round(t * 3 / 2e7::DOUBLE, 6) AS parameters_millions FROM total""",
        "token_length_stats": f"""{WITH_SEQUENCES}
            SELECT max(len(ids)) AS max_tokens, min(len(ids)) AS min_tokens FROM sequences
            WHERE split = 'train'""",
        "tokenizer_eval": f"WITH {split_cte()}, {STAND_IN} {EVALUATION.format(table='stand_in')}",
        "corpus_chars": "SELECT (sum(length(text)) + count(*) - 1)::BIGINT AS n_chars FROM documents",
        "write_read_back": f"""{WITH_SEQUENCES}
            SELECT split, doc_id, {_text('ids')} AS ids FROM sequences""",
        "text_export": """SELECT unnest(string_split(text, chr(10))) AS line FROM documents""",
        "word_counts_char": f"WITH {counts_cte('char')} SELECT word, n FROM counts",
        "word_counts_byte": f"""WITH {counts_cte('byte')}
            SELECT string_agg(letter, '' ORDER BY pos) AS word, any_value(n) AS n FROM letters GROUP BY letters.word""",
        "bpe_pair_counts": f"""WITH {counts_cte('char')}
            SELECT a.token AS "left", b.token AS "right", sum(a.n)::BIGINT AS n
            FROM letters a JOIN letters b ON b.word = a.word AND b.pos = a.pos + 1 GROUP BY 1, 2""",
        "bpe_pair_counts_byte": f"""WITH {counts_cte('byte')}
            SELECT a.token AS "left", b.token AS "right", sum(a.n)::BIGINT AS n
            FROM letters a JOIN letters b ON b.word = a.word AND b.pos = a.pos + 1 GROUP BY 1, 2""",
        "bpe_train": f"{trained('char', size=VOCAB_SIZE)} {MERGES}",
        "bpe_train_byte": f"{trained('byte', size=VOCAB_SIZE)} {MERGES}",
        "bpe_train_2000": f"{trained('char')} {MERGES}",
        "bpe_train_byte_2000": f"{trained('byte')} {MERGES}",
        "bpe_vocab": f"{trained('char')} SELECT token, id, is_special FROM vocab",
        "bpe_vocab_byte": f"{trained('byte')} SELECT token, id, is_special FROM vocab",
        "vocab_specials": f"""{trained('char')}
            SELECT token, id, is_special, (SELECT count(*) FROM vocab) AS vocab_size
            FROM vocab WHERE token LIKE '<%'""",
        "special_ids": f"""{trained('char')}
            SELECT max(id) FILTER (token = '<|pad|>') AS pad_id, max(id) FILTER (token = '<|end_of_text|>') AS eot_id,
                   max(id) FILTER (token = '<unk>') AS unk_id FROM vocab""",
        "eot_id": f"""{trained('char')}
            SELECT coalesce(max(id) FILTER (token = '<|end_of_text|>'), max(id) FILTER (token = '</s>'), 2) AS eot_id
            FROM vocab""",
        "tokenizer_saved": f"{trained('byte')} {MERGES}",
        "tokenizer_json": f"{trained('char')} {MERGES}",
        "encode": f"{encoded('char')} {ENCODED}",
        "encode_byte": f"{encoded('byte')} {ENCODED}",
        "encode_benchmark": f"{encoded('char', held_out)} {ENCODED}",
        "encode_stream": f"{encoded('char')} {ENCODED}",
        "encode_specials": f"""{encoded('char')}
            SELECT doc_id, {_text('list_prepend(1, list_append(raw_ids, 2))')} AS raw_ids, {DECODED_CHAR} AS decoded
            FROM encoded JOIN documents USING (doc_id)""",
        "stored_names": f"""{trained('char')}
            SELECT 'vb-' || count(*) || '-char_bpe-v1' AS tokenizer, 'corpus-' || count(*) || '-v1' AS dataset FROM vocab""",
        "decode": f"SELECT doc_id, {DECODED_CHAR} AS decoded FROM documents",
        "decode_byte": f"SELECT doc_id, {byte_decoded} AS decoded FROM documents",
        "round_trip": round_trip_sql(DECODED_CHAR),
        "round_trip_byte": round_trip_sql(byte_decoded),
        "train_metrics": f"""WITH RECURSIVE {split_cte()},
            train_texts AS (SELECT * FROM split_docs WHERE split = 'train'),
            {training_cte('char', 'train_texts')}, {encoded_cte('char', 'split_docs')},
            measured AS (SELECT p.split, p.text, e.raw_ids FROM split_docs p JOIN encoded e USING (doc_id))
            {EVALUATION.format(table='measured')}""",
        "model_ready": f"""WITH RECURSIVE {split_cte()},
            {training_cte('char')}, {encoded_cte('char', 'split_docs')}
            SELECT p.split, p.doc_id, p.lang, p.source, {_text('e.raw_ids')} AS input_ids,
                   {_text('list_append(e.raw_ids, 2)[2:]')} AS output_ids
            FROM split_docs p JOIN encoded e USING (doc_id)""",
        "user_map_rows": """
            SELECT doc_id, string_split(text, chr(10))[1] AS first_line, len(string_split(text, chr(10)))::INT AS n_lines FROM documents""",
        "softmax_scores": f"{SCORES.format(t=0.7)} SELECT vec_id, token_id, round(prob, 6) AS prob FROM soft",
        "topk_candidates": f"{TOP_K.format(t=0.2, k=5)} SELECT vec_id, token_id, round(prob, 6) AS prob FROM kept",
        "topp_candidates": f"{TOP_P.format(t=0.2, p=0.9)} SELECT vec_id, token_id, round(prob, 6) AS prob FROM kept",
        "seeded_draw": DRAW.format(t=0.2, p=0.9),
        "cross_entropy": f"""{SCORES.format(t=1.0)},
            each AS (
              SELECT any_value(best) + ln(sum(exp(score - best))) - any_value(score) FILTER (token_id = label) AS l
              FROM top GROUP BY vec_id)
            SELECT round(avg(l), 6) AS loss FROM each""",
        "epoch_losses": f"""{LOG},
            means AS (
              SELECT run, epoch, avg(loss) FILTER (split = 'train') AS t, avg(loss) FILTER (split = 'validation') AS v
              FROM log GROUP BY run, epoch)
            SELECT run, epoch, round(t + 1e-9::DOUBLE, 6) AS train_loss, round(v + 1e-9::DOUBLE, 6) AS val_loss,
                   round(v - t + 1e-9::DOUBLE, 6) AS val_train_difference FROM means""",
        "running_loss": f"""{LOG}
            SELECT run, epoch, split, batch_num, round(1e-9::DOUBLE + avg(loss) OVER (
              PARTITION BY run, epoch, split ORDER BY batch_num
              ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 6) AS avg_so_far FROM log""",
        "global_step": f"""{LOG},
            sizes AS (SELECT run, epoch, split, count(*) AS n FROM log GROUP BY ALL),
            batches AS (SELECT run, split, max(n) AS n_batches FROM sizes GROUP BY ALL)
            SELECT run, epoch, split, batch_num, (epoch - 1) * n_batches + batch_num AS step
            FROM log JOIN batches USING (run, split)""",
    }
