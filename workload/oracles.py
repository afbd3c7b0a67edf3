"""The same results as ANSI SQL for DuckDB, written from the definitions and not from the Spark code."""

from __future__ import annotations

from loomset.functions.templates import (
    ALPACA_NO_INPUT,
    ALPACA_WITH_INPUT,
)
from loomset.operators.cost import HOURLY_PRICES
from workload.views import INSTANCE_TYPES, MODELS

# Whitespace and letter classes in DuckDB's regular expressions.
WS = r"\s\x0b\x1c-\x1f\x{85}\p{Z}"


def lit(text: str) -> str:
    """A SQL text literal; line breaks become chr(10)."""
    parts = ["'" + p.replace("'", "''") + "'" for p in text.split("\n")]
    return "(" + " || chr(10) || ".join(parts) + ")"


def strip(c: str) -> str:
    return f"regexp_replace({c}, '^[{WS}]+|[{WS}]+$', '', 'g')"


def rnd(c: str, digits: int) -> str:
    """Rounded on the exact binary value, as formatting does."""
    return f"CAST(format('{{:.{digits}f}}', CAST({c} AS DOUBLE)) AS DOUBLE)"


def toks(c: str) -> str:
    return f"list_filter(regexp_split_to_array(lower({c}), '[{WS}]+'), lambda t: t <> '')"


def with_(*views: str, body: str) -> str:
    return "WITH " + ", ".join(VIEWS[v] for v in views) + " " + body


HEAD = "split_part(text, '.', 1)"
UNIFIED_COLUMNS = f"""doc_id AS row_id, {HEAD} AS instruction,
    CASE doc_id % 3 WHEN 0 THEN source WHEN 1 THEN '' ELSE '  ' END AS input,
    substr(text, length({HEAD}) + 2) AS output"""

VIEWS = {
    "unified": f"unified AS (SELECT {UNIFIED_COLUMNS}, source, lang FROM documents)",
    "turns_unified": """turns_unified AS (
        SELECT * FROM (
            SELECT conv_id AS row_id,
                arg_min(text, turn) FILTER (WHERE role IN ('human', 'user') AND text <> '') AS instruction,
                '' AS input,
                arg_min(text, turn) FILTER (WHERE role IN ('gpt', 'assistant') AND text <> '') AS output,
                count(*) AS n
            FROM conversations GROUP BY conv_id)
        WHERE n >= 2 AND instruction IS NOT NULL AND output IS NOT NULL)""",
    "flagged": f"""stripped AS (
        SELECT *, {strip('instruction')} AS i, {strip('output')} AS o FROM unified),
    quality AS (
        SELECT *, CASE
            WHEN i = '' THEN 'empty_instruction'
            WHEN o = '' THEN 'empty_output'
            WHEN length(i) < 5 THEN 'instruction_too_short'
            WHEN length(o) < 3 THEN 'output_too_short'
            WHEN length(regexp_replace(i || o, '[\\p{{L}}\\p{{N}}{WS}]', '', 'g')) / greatest(length(i || o), 1) > 0.5
                THEN 'corrupted_text' END AS quality_reason
        FROM stripped),
    local_reason AS (
        SELECT *, coalesce(quality_reason, CASE
            WHEN length(instruction) + length(input) + length(output) NOT BETWEEN 10 AND 8192
            THEN 'length_out_of_range' END) AS lr
        FROM quality),
    flagged AS (
        SELECT *, CASE WHEN lr IS NOT NULL THEN lr
            WHEN row_number() OVER (PARTITION BY lr IS NULL, i || '|||' || o ORDER BY row_id) > 1
            THEN 'duplicate' END AS reason
        FROM local_reason)""",
    "pairs": """ranked_turns AS (
        SELECT conv_id, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS rn
        FROM conversations WHERE role = 'assistant'),
    pairs AS (
        SELECT a.conv_id AS pair_id, a.text AS prediction, b.text AS reference
        FROM ranked_turns a JOIN ranked_turns b ON a.conv_id = b.conv_id AND a.rn = 1 AND b.rn = 2)""",
    "runs": """runs AS (
        SELECT user_id AS run_id, event_id AS step, ts, value AS eval_loss,
            row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS rn
        FROM events)""",
    "stopping": """stopping AS (
        WITH RECURSIVE fold AS (
            SELECT run_id, step, rn, eval_loss, eval_loss AS best_loss, CAST(0 AS BIGINT) AS wait_count
            FROM runs WHERE rn = 1
            UNION ALL
            SELECT r.run_id, r.step, r.rn, r.eval_loss,
                CASE WHEN r.eval_loss < f.best_loss - 0.001 THEN r.eval_loss ELSE f.best_loss END,
                CASE WHEN r.eval_loss < f.best_loss - 0.001 THEN 0 ELSE f.wait_count + 1 END
            FROM fold f JOIN runs r ON r.run_id = f.run_id AND r.rn = f.rn + 1)
        SELECT *, wait_count >= 3 AS should_stop FROM fold)""",
    "train_events": """train_events AS (
        SELECT user_id AS run_id, event_id AS step, ts, event_id % 8 + 1 AS num_samples,
            CASE WHEN event_type IN ('click', 'view') THEN value END AS loss,
            CASE WHEN event_type = 'click' THEN value / 1000 END AS learning_rate,
            CASE WHEN event_type = 'view' THEN value / 2 END AS grad_norm,
            CASE WHEN event_type IN ('purchase', 'signup') THEN value END AS eval_loss,
            CASE WHEN event_type = 'purchase' THEN value * 2 END AS eval_runtime,
            CASE WHEN event_type = 'signup' THEN value / 4 END AS eval_samples_per_second
        FROM events)""",
    "scored": "scored AS (SELECT event_type AS run, value / 100 AS loss, event_id % 512 + 1 AS num_tokens FROM events)",
    "registry": """registry AS (
        SELECT event_id AS seq, event_type AS name, 'v' || (event_id % 50) AS version,
            'models/' || event_id AS path, 'registered' AS status, ts AS registered_at, value AS eval_loss,
            CASE WHEN event_id % 3 = 0 THEN CAST(regexp_extract(props, '(\\d+)', 1) AS DOUBLE) / 100 END AS accuracy
        FROM events)""",
    "results": f"""per_model AS (
        SELECT event_type AS model_name, count(*) AS num_samples,
            exp(sum(value / 100 * (event_id % 512 + 1)) / sum(event_id % 512 + 1)) AS perplexity,
            avg(value) AS loss,
            CASE WHEN event_type <> 'signup' THEN avg(CASE WHEN value > 10 THEN 1.0 ELSE 0.0 END) END AS accuracy
        FROM events GROUP BY event_type),
    placed AS (SELECT CAST(list_position({MODELS!r}, model_name) - 1 AS INTEGER) AS pos, * FROM per_model),
    results AS (
        SELECT pos, model_name, 'events' AS dataset_name, num_samples, m.no AS metric_no, m.name AS metric,
            round(CASE m.no WHEN 0 THEN perplexity WHEN 1 THEN loss ELSE accuracy END, 6) AS value
        FROM placed CROSS JOIN (VALUES (0, 'perplexity'), (1, 'loss'), (2, 'accuracy')) AS m(no, name)
        WHERE (CASE m.no WHEN 0 THEN perplexity WHEN 1 THEN loss ELSE accuracy END) IS NOT NULL)""",
    "usage": f"""usage AS (
        SELECT event_id AS usage_id, ({INSTANCE_TYPES!r})[CAST(event_id % {len(INSTANCE_TYPES)} AS INTEGER) + 1]
            AS instance_type, value AS hours FROM events)""",
    # Multisets of 1-, 2- and 3-grams on both sides of a pair.
    "grams": f"""tok AS (
        SELECT pair_id, {toks('prediction')} AS p, {toks('reference')} AS r FROM pairs),
    sizes AS (SELECT pair_id, n, greatest(len(p) - n + 1, 0) AS np, greatest(len(r) - n + 1, 0) AS nr,
        len(p) AS lp, len(r) AS lrr, p, r FROM tok CROSS JOIN (VALUES (1), (2), (3)) AS v(n)),
    gp AS (SELECT pair_id, n, array_to_string(p[k:k + n - 1], ' ') AS g, count(*) AS c
        FROM (SELECT pair_id, n, p, unnest(range(1, np + 1)) AS k FROM sizes) GROUP BY ALL),
    gr AS (SELECT pair_id, n, array_to_string(r[k:k + n - 1], ' ') AS g, count(*) AS c
        FROM (SELECT pair_id, n, r, unnest(range(1, nr + 1)) AS k FROM sizes) GROUP BY ALL),
    hits AS (SELECT gp.pair_id, gp.n, sum(least(gp.c, gr.c)) AS shared
        FROM gp JOIN gr ON gp.pair_id = gr.pair_id AND gp.n = gr.n AND gp.g = gr.g GROUP BY ALL),
    grams AS (
        SELECT s.pair_id, s.n, np, nr, coalesce(shared, 0) AS shared,
            CASE WHEN coalesce(shared, 0) = 0 THEN 0.0
                ELSE 2 * (shared / np) * (shared / nr) / (shared / np + shared / nr) END AS f1,
            CASE WHEN np = 0 OR nr = 0 THEN 0.0
                ELSE least(1.0, np / nr) * (coalesce(shared, 0) / np) END AS bleu
        FROM sizes s LEFT JOIN hits h ON s.pair_id = h.pair_id AND s.n = h.n)""",
    # Row by row of the longest-common-subsequence table: a cell is the maximum of the cell above
    # and of all cells to the left or diagonal that extend by an equal token.
    "lcs": f"""tokl AS (
        SELECT pair_id, {toks('prediction')} AS p, {toks('reference')} AS r FROM pairs),
    lcs_rows AS (
        WITH RECURSIVE dp AS (
            SELECT pair_id, 0 AS i, p, r, list_transform(range(0, len(r) + 1), lambda x: 0) AS cells FROM tokl
            UNION ALL
            SELECT pair_id, i + 1, p, r, list_reduce(
                list_transform(range(1, len(r) + 1), lambda j: [greatest(cells[j + 1],
                    CASE WHEN r[j] = p[i + 1] THEN cells[j] + 1 ELSE 0 END)]),
                lambda acc, x: list_append(acc, greatest(acc[len(acc)], x[1])), [0])
            FROM dp WHERE i < len(p))
        SELECT pair_id, i, len(p) AS np, len(r) AS nr, cells[len(cells)] AS shared FROM dp),
    lcs AS (SELECT pair_id, CASE WHEN shared = 0 THEN 0.0
            ELSE 2 * (shared / np) * (shared / nr) / (shared / np + shared / nr) END AS f1
        FROM lcs_rows WHERE i = np)""",
    "echoed": f"""echoed AS (
        SELECT row_id AS pair_id, 'Answer: ' || instruction AS prediction, output AS reference FROM turns_unified),
    pairs AS (SELECT * FROM echoed)""",
    "answers": """answers AS (
        SELECT pair_id, prediction AS generated_text, CASE pair_id % 3
            WHEN 0 THEN ' ' || substr(prediction, 3, 10) || chr(10)
            WHEN 1 THEN reference ELSE substr(reference, 1, 5) END AS expected
        FROM pairs)""",
    "sampled": """sampled AS (
        SELECT row_number() OVER (ORDER BY md5(row_id || ':42'), row_id) AS sample_id,
            instruction AS prompt, output AS reference, 'Answer: ' || instruction AS generated,
            row_id AS source_row
        FROM turns_unified QUALIFY sample_id <= 50)""",
}

ROWS = "row_id, instruction, input, output"
REGISTRY_ROWS = "seq, name, version, path, status, registered_at, eval_loss, accuracy"


def rendered(train: str, inference: str) -> dict[str, str]:
    return {"train": train, "inference": inference}


HAS_INPUT = f"{strip('input')} <> ''"
USER = f"(CASE WHEN {HAS_INPUT} THEN instruction || chr(10) || input ELSE instruction END)"
ALPACA_HEAD = (
    f"(CASE WHEN {HAS_INPUT} THEN {lit(ALPACA_WITH_INPUT)} || {lit(chr(10) * 2 + '### Instruction:' + chr(10))} || instruction"
    f" || {lit(chr(10) * 2 + '### Input:' + chr(10))} || input"
    f" ELSE {lit(ALPACA_NO_INPUT)} || {lit(chr(10) * 2 + '### Instruction:' + chr(10))} || instruction END"
    f" || {lit(chr(10) * 2 + '### Response:' + chr(10))})"
)
CHATML_HEAD = f"{lit('<|im_start|>user' + chr(10))} || {USER} || {lit('<|im_end|>' + chr(10) + '<|im_start|>assistant' + chr(10))}"
LLAMA3_HEAD = (
    f"{lit('<|begin_of_text|><|start_header_id|>user<|end_header_id|>' + chr(10) * 2)} || {USER}"
    f" || {lit('<|eot_id|><|start_header_id|>assistant<|end_header_id|>' + chr(10) * 2)}"
)
MISTRAL_HEAD = f"'[INST] ' || {USER} || ' [/INST] '"
TEXTS = {
    "alpaca": rendered(f"{ALPACA_HEAD} || output", ALPACA_HEAD),
    "chatml": rendered(f"{CHATML_HEAD} || output || '<|im_end|>'", CHATML_HEAD),
    "llama3": rendered(f"{LLAMA3_HEAD} || output || '<|eot_id|>'", LLAMA3_HEAD),
    "mistral": rendered(f"{MISTRAL_HEAD} || output", MISTRAL_HEAD),
}


def split_sql(rows: str, columns: str, held_ratio: float, test_share: float, seed: int) -> str:
    """Exact global ranks in hash order; the first rows are test, the next validation."""
    return f"""SELECT {columns}, CASE WHEN rk <= n_test THEN 'test' WHEN rk <= held THEN 'validation' ELSE 'train' END AS split
        FROM (SELECT *, CAST(ceil(CAST({test_share} AS DOUBLE) * held) AS BIGINT) AS n_test FROM (
            SELECT *, row_number() OVER (ORDER BY md5(row_id || ':{seed}'), row_id) AS rk,
                CAST(ceil(CAST({held_ratio} AS DOUBLE) * count(*) OVER ()) AS BIGINT) AS held
            FROM {rows}))"""


KEPT = "(SELECT * FROM flagged WHERE reason IS NULL)"
SECONDS = "(epoch_us(ts) - epoch_us(start_ts)) / 1000000.0"
ETA = f"""CASE WHEN step > 0 AND total_steps > 0
    THEN CAST({SECONDS} AS DOUBLE) / step * (total_steps - step) ELSE 0.0 END"""
PROGRESS = f"""bounds AS (SELECT run_id, min(ts) AS start_ts, max(step) AS total_steps FROM train_events GROUP BY run_id)
    SELECT run_id, step, total_steps,
        {rnd(SECONDS, 1)} AS elapsed_s, {rnd(ETA, 1)} AS eta_s,
        {rnd('loss', 4)} AS loss, learning_rate AS lr, {rnd('grad_norm', 4)} AS grad_norm
    FROM train_events JOIN bounds USING (run_id) WHERE step % 5 = 0 OR step = total_steps"""
METRIC_ROWS = """SELECT run_id, step, 'train/' || metric AS metric, round(value, 6) AS value
    FROM (UNPIVOT (SELECT run_id, step, loss, learning_rate, grad_norm, eval_loss FROM train_events)
        ON loss, learning_rate, grad_norm, eval_loss INTO NAME metric VALUE value)"""
STATES = "SELECT run_id, step, round(eval_loss, 6) AS eval_loss, round(best_loss, 6) AS best_loss, wait_count, should_stop FROM stopping"
ACCURACY_HIT = f"(contains(lower({strip('generated_text')}), lower({strip('expected')})) OR contains(lower({strip('expected')}), lower({strip('generated_text')})))"
PRICES = ", ".join(f"('{k}', {v}::DOUBLE)" for k, v in HOURLY_PRICES.items())
REASON_ROWS = "SELECT reason, count(*) AS n FROM flagged WHERE reason IS NOT NULL GROUP BY reason"
MEANS = """SELECT
        (SELECT coalesce(round(avg(bleu), 6), 0.0) FROM grams WHERE n = 1) AS bleu,
        (SELECT coalesce(round(avg(f1), 6), 0.0) FROM grams WHERE n = 1) AS rouge_1,
        (SELECT coalesce(round(avg(f1), 6), 0.0) FROM grams WHERE n = 2) AS rouge_2,
        (SELECT coalesce(round(avg(f1), 6), 0.0) FROM lcs) AS rouge_l"""
LATEST = f"SELECT {REGISTRY_ROWS} FROM registry"
MARKDOWN_LINES = """sheet AS (
    SELECT CASE WHEN sample_id = 1 THEN '# Human Evaluation Samples' || chr(10) ELSE '' END
        || '## Sample ' || sample_id || chr(10)
        || '**Prompt:**' || chr(10) || '```' || chr(10) || prompt || chr(10) || '```' || chr(10)
        || CASE WHEN reference <> '' THEN '**Reference:**' || chr(10) || '```' || chr(10) || reference || chr(10) || '```' || chr(10) ELSE '' END
        || '**Generated:**' || chr(10) || '```' || chr(10) || generated || chr(10) || '```' || chr(10)
        || '**Rating:** [ ] 1  [ ] 2  [ ] 3  [ ] 4  [ ] 5' || chr(10) || '**Notes:**' || chr(10) || '---' AS block
    FROM sampled)
    SELECT line, count(*) AS n FROM (SELECT unnest(string_split(block, chr(10))) AS line FROM sheet)
    WHERE line <> '' GROUP BY line"""


ORACLES: dict[str, str] = {
    "json_array_source": with_("unified", body=f"SELECT {ROWS} FROM unified"),
    "csv_source": with_("unified", body=f"SELECT {ROWS} FROM unified"),
    "json_lines_source": with_("unified", body=f"SELECT {ROWS} FROM unified"),
    "json_array_quarantine": with_(
        "unified",
        body="""SELECT row_id, instruction, input, output, NULL::VARCHAR AS value FROM unified WHERE (row_id // 100) % 7 <> 3
            UNION ALL SELECT NULL, NULL, NULL, NULL, '[' || string_agg(row_id::VARCHAR, ',' ORDER BY row_id)
            FROM unified WHERE (row_id // 100) % 7 = 3 GROUP BY row_id // 100""",
    ),
    "json_lines_quarantine": with_(
        "unified",
        body="""SELECT row_id, instruction, input, output, NULL::VARCHAR AS value FROM unified WHERE row_id % 7 <> 3
            UNION ALL SELECT NULL, NULL, NULL, NULL, '{"row_id":' || row_id || ',' FROM unified WHERE row_id % 7 = 3""",
    ),
    "parquet_source": with_("unified", body="SELECT row_id, instruction, '' AS input, output FROM unified"),
    "named_split_scan": with_("unified", body=f"SELECT {ROWS} FROM unified WHERE lang = 'en'"),
    "split_sink_readback": with_(
        "unified",
        body=split_sql(f"(SELECT row_id, {TEXTS['mistral']['train']} AS text FROM unified)", "text", 0.1, 0.5, 42),
    ),
    "review_csv_readback": with_(
        "turns_unified", "sampled",
        body="SELECT sample_id, prompt, reference, generated, '' AS rating, '' AS notes FROM sampled",
    ),
    "review_json_readback": with_(
        "turns_unified", "sampled",
        body="""SELECT sample_id, prompt, reference, generated, TRUE AS unrated, '' AS notes,
            source_row, CAST(0.7 AS DOUBLE) AS temperature FROM sampled""",
    ),
    "review_markdown_readback": "WITH " + ", ".join([VIEWS["turns_unified"], VIEWS["sampled"], MARKDOWN_LINES]),
    "metrics_sink_readback": with_("results", body="SELECT * FROM results"),
    "registry_scan": with_("registry", body=LATEST),
    "unify_alpaca": with_("unified", body=f"SELECT {ROWS} FROM unified"),
    "unify_alpaca_no_input": with_("unified", body="SELECT row_id, instruction, '' AS input, output FROM unified"),
    "unify_dolly": with_("unified", body=f"SELECT {ROWS} FROM unified"),
    "unify_oasst": with_("unified", body="SELECT row_id, instruction, '' AS input, output FROM unified"),
    "unify_explicit_format": with_("unified", body="SELECT row_id, instruction, '' AS input, '' AS output FROM unified"),
    "unify_nested_messages": with_(
        "unified",
        body="""SELECT row_id, instruction, '' AS input, output FROM unified
            WHERE row_id % 5 <> 3 AND row_id % 5 <> 4 AND instruction <> '' AND output <> ''
            UNION ALL
            SELECT row_id, instruction, '', CASE WHEN output <> '' THEN output ELSE instruction END FROM unified
            WHERE row_id % 5 = 4 AND instruction <> ''""",
    ),
    "unify_turns": with_("turns_unified", body=f"SELECT {ROWS} FROM turns_unified"),
    **{
        f"template_{name}_{mode}": with_("unified", body=f"SELECT row_id, {text} AS text FROM unified")
        for name, modes in TEXTS.items()
        for mode, text in modes.items()
    },
    "template_custom": with_(
        "unified",
        body=f"SELECT row_id, 'Q: ' || {strip('instruction')} || chr(10) || 'A: ' || {strip('output')} AS text FROM unified",
    ),
    "length_filter": with_(
        "unified",
        body=f"SELECT {ROWS} FROM unified WHERE length(instruction) + length(input) + length(output) BETWEEN 10 AND 8192",
    ),
    "quality_filter": with_("unified", "flagged", body=f"SELECT {ROWS} FROM flagged WHERE quality_reason IS NULL"),
    "quality_counts": with_(
        "unified", "flagged",
        body="SELECT quality_reason AS reason, count(*) AS n FROM flagged WHERE quality_reason IS NOT NULL GROUP BY 1",
    ),
    "special_ratio": with_(
        "unified", "flagged",
        body=f"""SELECT row_id, round(length(regexp_replace(i || o, '[\\p{{L}}\\p{{N}}{WS}]', '', 'g'))
            / greatest(length(i || o), 1), 6) AS special_ratio FROM stripped""",
    ),
    "exact_dedup": with_(
        "unified", "flagged",
        body=f"""SELECT {ROWS} FROM stripped
            QUALIFY row_number() OVER (PARTITION BY i || '|||' || o ORDER BY row_id) = 1""",
    ),
    "validation_kept": with_("unified", "flagged", body=f"SELECT {ROWS} FROM flagged WHERE reason IS NULL"),
    "validation_flags": with_("unified", "flagged", body="SELECT row_id, reason FROM flagged"),
    "validation_reasons": with_("unified", "flagged", body=REASON_ROWS),
    "validation_report": with_(
        "unified", "flagged",
        body="""SELECT count(*) AS original_count, count(*) FILTER (WHERE reason IS NULL) AS filtered_count,
            count(reason) AS removed_count, round(count(reason) / count(*), 6) AS removal_rate FROM flagged""",
    ),
    "validation_summary": with_(
        "unified", "flagged",
        body=f"""SELECT 'Validation Report:' || chr(10)
            || '  Original samples: ' || (SELECT count(*) FROM flagged) || chr(10)
            || '  Filtered samples: ' || (SELECT count(*) FROM flagged WHERE reason IS NULL) || chr(10)
            || '  Removed: ' || (SELECT count(reason) FROM flagged) || ' ('
            || (SELECT format('{{:.1f}}', 100 * count(reason) / count(*)) FROM flagged) || '%)' || chr(10)
            || '  Removal reasons:' || chr(10)
            || (SELECT string_agg('    - ' || reason || ': ' || n, chr(10) ORDER BY n DESC, reason)
                FROM ({REASON_ROWS})) AS summary""",
    ),
    "dataset_stats": with_(
        "unified",
        body=f"""SELECT count(*) AS num_samples,
            round(avg(length(instruction)), 6) AS avg_instruction_len, round(avg(length(input)), 6) AS avg_input_len,
            round(avg(length(output)), 6) AS avg_output_len,
            max(length(instruction)) AS max_instruction_len, max(length(input)) AS max_input_len,
            max(length(output)) AS max_output_len, min(length(instruction)) AS min_instruction_len,
            min(length(input)) AS min_input_len, min(length(output)) AS min_output_len,
            count(*) FILTER (WHERE {strip('input')} = '') AS empty_input_count FROM unified""",
    ),
    "token_histogram": with_(
        "unified",
        body="""SELECT b.bucket, count(u.t) AS n
            FROM (VALUES ('0-128', 0, 128), ('128-256', 128, 256), ('256-512', 256, 512), ('512-1024', 512, 1024),
                ('1024+', 1024, 9223372036854775807)) AS b(bucket, lo, hi)
            LEFT JOIN (SELECT (length(instruction) + length(input) + length(output)) // 4 AS t FROM unified) u
                ON u.t >= b.lo AND u.t < b.hi GROUP BY b.bucket""",
    ),
    "random_split": with_("unified", body=split_sql("unified", "row_id", 0.1, 0.5, 42)),
    "random_split_two_way": with_("unified", body=split_sql("unified", "row_id", 0.1, 0.0, 7)),
    "stratified_split": with_(
        "unified",
        body="""SELECT row_id, source, CASE WHEN rk <= n_train THEN 'train' WHEN rk <= n_train + n_val THEN 'validation'
                ELSE 'test' END AS split
            FROM (SELECT *, greatest(1, round_even(n * 0.9::DOUBLE, 0)) AS n_train, round_even(n * 0.05::DOUBLE, 0) AS n_val
                FROM (SELECT *, row_number() OVER (PARTITION BY source ORDER BY md5(row_id || ':42'), row_id) AS rk,
                    count(*) OVER (PARTITION BY source) AS n FROM unified))""",
    ),
    "seeded_sample": with_(
        "unified",
        body=f"SELECT row_number() OVER (ORDER BY md5(row_id || ':42'), row_id) AS sample_id, {ROWS} FROM unified QUALIFY sample_id <= 200",
    ),
    "bleu_pairs": with_("pairs", "grams", body="SELECT pair_id, round(bleu, 6) AS bleu FROM grams WHERE n = 1"),
    "bleu_mean": with_("pairs", "grams", body="SELECT round(avg(bleu), 6) AS bleu FROM grams WHERE n = 1"),
    **{
        f"rouge_{n}_pairs": with_("pairs", "grams", body=f"SELECT pair_id, round(f1, 6) AS rouge_{n} FROM grams WHERE n = {n}")
        for n in (1, 2, 3)
    },
    "rouge_l_pairs": with_("pairs", "lcs", body="SELECT pair_id, round(f1, 6) AS rouge_l FROM lcs"),
    "rouge_means": with_("pairs", "grams", "lcs", body=f"SELECT rouge_1, rouge_2, rouge_l FROM ({MEANS})"),
    "text_metrics": with_("pairs", "grams", "lcs", body=MEANS),
    "pair_alignment": with_("pairs", body="SELECT * FROM pairs"),
    "unaligned_pairs": """SELECT conv_id AS pair_id, CASE WHEN answers > 0 THEN 'prediction' ELSE 'reference' END AS side
        FROM (SELECT conv_id, count(*) FILTER (WHERE role = 'assistant') AS answers,
                count(*) FILTER (WHERE role = 'user') AS questions FROM conversations GROUP BY conv_id)
        WHERE (answers >= 1) <> (questions >= 2)""",
    "task_accuracy": with_(
        "pairs", "answers",
        body=f"SELECT round(avg(CASE WHEN {ACCURACY_HIT} THEN 1.0 ELSE 0.0 END), 6) AS accuracy, count(*) AS n FROM answers",
    ),
    "task_accuracy_strict": with_(
        "pairs", "answers",
        body=f"""SELECT round(avg(CASE WHEN lower({strip('generated_text')}) = lower({strip('expected')})
            THEN 1.0 ELSE 0.0 END), 6) AS accuracy, count(*) AS n FROM answers""",
    ),
    "perplexity": with_(
        "scored",
        body="""SELECT run, round(exp(sum(loss * num_tokens) / sum(num_tokens)), 6) AS perplexity,
            CAST(sum(num_tokens) AS BIGINT) AS total_tokens FROM scored GROUP BY run""",
    ),
    "batch_ids": with_("unified", body="SELECT row_id, (row_number() OVER (ORDER BY row_id) - 1) // 4 AS batch_id FROM unified"),
    "wide_results": with_(
        "results",
        body="""SELECT pos, model_name, dataset_name, num_samples,
            max(value) FILTER (WHERE metric = 'perplexity') AS perplexity, max(value) FILTER (WHERE metric = 'bleu') AS bleu,
            max(value) FILTER (WHERE metric = 'rouge_l') AS rouge_l, max(value) FILTER (WHERE metric = 'accuracy') AS accuracy
            FROM results GROUP BY ALL""",
    ),
    "result_union": with_(
        "results",
        body="SELECT CAST(4 - pos AS INTEGER) AS pos, model_name, dataset_name, num_samples, metric_no, metric, value FROM results",
    ),
    "best_models": with_(
        "results",
        body="""SELECT metric, model_name, value FROM results QUALIFY row_number() OVER (PARTITION BY metric
            ORDER BY CASE WHEN metric IN ('perplexity', 'loss', 'eval_loss') THEN value ELSE -value END, pos) = 1""",
    ),
    "improvement": with_(
        "results",
        body="""SELECT a.metric, round(a.value, 6) AS base_value, round(b.value, 6) AS finetuned_value,
            round(b.value - a.value, 6) AS absolute_change,
            round(CASE WHEN a.value = 0 THEN 0.0 ELSE (b.value - a.value) / a.value END, 6) AS relative_change
            FROM results a JOIN results b ON a.metric = b.metric
            WHERE a.pos = (SELECT min(pos) FROM results) AND b.pos = (SELECT max(pos) FROM results)""",
    ),
    "evaluation_summaries": with_(
        "results",
        body="""SELECT pos, model_name, 'Evaluation Results:' || chr(10) || '  Model: ' || model_name || chr(10)
            || '  Dataset: ' || dataset_name || chr(10) || '  Samples: ' || num_samples || chr(10)
            || format('  Perplexity: {:.2f}', max(value) FILTER (WHERE metric = 'perplexity'))
            || coalesce(chr(10) || format('  Accuracy: {:.2f}%', 100 * max(value) FILTER (WHERE metric = 'accuracy')), '') AS summary
            FROM results GROUP BY pos, model_name, dataset_name, num_samples""",
    ),
    "comparison_lines": with_(
        "results",
        body="""SELECT 0 AS part, 0 AS pos, unnest(['Model Comparison Report:', '  Dataset: events',
                '  Models compared: ' || (SELECT count(DISTINCT pos) FROM results)]) AS line
            UNION ALL SELECT DISTINCT 1, pos, '  ' || model_name || ':' FROM results
            UNION ALL SELECT 1, pos, format('    {}: {:.4f}', metric, value) FROM results
            UNION ALL SELECT 2, 0, '  Best perplexity: ' || (SELECT model_name FROM results WHERE metric = 'perplexity' ORDER BY value, pos LIMIT 1)
            UNION ALL SELECT 2, 0, format('  Perplexity change: {:+.2f} ({:+.1f}%)', b.value - a.value, 100 * (b.value - a.value) / a.value)
                FROM results a, results b WHERE a.metric = 'perplexity' AND b.metric = 'perplexity' AND a.pos = 0 AND b.pos = 4""",
    ),
    "registry_register": with_(
        "registry",
        body=f"""{LATEST} UNION ALL
            SELECT max(seq) OVER () + row_number() OVER (ORDER BY seq), name, 'v-next', path, status, TIMESTAMP '2025-01-01 00:00:00', eval_loss, accuracy FROM registry""",
    ),
    "latest_versions": with_(
        "registry",
        body=f"{LATEST} QUALIFY row_number() OVER (PARTITION BY name ORDER BY registered_at DESC, seq) = 1",
    ),
    "best_versions": with_(
        "registry", body=f"{LATEST} QUALIFY row_number() OVER (PARTITION BY name ORDER BY eval_loss, seq) = 1"
    ),
    "best_versions_by_accuracy": with_(
        "registry",
        body=f"{LATEST} WHERE accuracy IS NOT NULL QUALIFY row_number() OVER (PARTITION BY name ORDER BY accuracy DESC, seq) = 1",
    ),
    "list_versions": with_("registry", body=f"{LATEST} WHERE name = 'purchase'"),
    "update_status": with_(
        "registry",
        body="""SELECT seq, name, version, path, CASE WHEN seq = min(seq) OVER (PARTITION BY name, version)
            THEN 'archived' ELSE status END AS status, registered_at, eval_loss, accuracy FROM registry""",
    ),
    "delete_versions": with_("registry", body=f"{LATEST} QUALIFY max(eval_loss) OVER (PARTITION BY name, version) <= 200"),
    "early_stopping": with_(
        "runs", "stopping",
        body="""SELECT run_id, count(*) AS num_evals, round(arg_max(best_loss, step), 6) AS best_loss,
            arg_max(wait_count, step) AS wait_count, min(step) FILTER (WHERE should_stop) AS stop_step
            FROM stopping GROUP BY run_id""",
    ),
    "early_stopping_states": with_("runs", "stopping", body=STATES),
    "early_stopping_stream": with_("runs", "stopping", body=STATES),
    "top_checkpoints": with_(
        "runs",
        body="""SELECT run_id, row_number() OVER (PARTITION BY run_id ORDER BY eval_loss, step) AS rank, step, eval_loss,
            'checkpoints/best/checkpoint-step-' || step AS path FROM runs QUALIFY rank <= 3""",
    ),
    "checkpoint_history": with_(
        "runs",
        body="""SELECT a.run_id, a.step, a.eval_loss,
                count(b.step) FILTER (WHERE b.step < a.step AND b.eval_loss <= a.eval_loss) < 3 AS admitted,
                count(b.step) FILTER (WHERE b.step < a.step AND b.eval_loss <= a.eval_loss) < 3
                    AND count(b.step) FILTER (WHERE (b.eval_loss, b.step) < (a.eval_loss, a.step)) >= 3 AS evicted
            FROM runs a JOIN runs b ON a.run_id = b.run_id GROUP BY a.run_id, a.step, a.eval_loss""",
    ),
    "best_checkpoint": with_(
        "runs",
        body="""SELECT run_id, 'checkpoints/best/checkpoint-step-' || step AS path, eval_loss, step
            FROM runs QUALIFY row_number() OVER (PARTITION BY run_id ORDER BY eval_loss, step) = 1""",
    ),
    "progress_rows": "WITH " + VIEWS["train_events"] + ", " + PROGRESS,
    "progress_stream": "WITH " + VIEWS["train_events"] + ", " + PROGRESS,
    "metric_rows": with_("train_events", body=METRIC_ROWS),
    "metric_rows_stream": with_("train_events", body=METRIC_ROWS),
    "eval_rows": with_(
        "train_events",
        body="""SELECT run_id, step, eval_loss, eval_runtime, eval_samples_per_second FROM train_events
            WHERE coalesce(eval_loss, eval_runtime, eval_samples_per_second) IS NOT NULL""",
    ),
    "run_summary": with_(
        "train_events",
        body=f"""SELECT run_id, arg_max(loss, step) FILTER (WHERE loss IS NOT NULL) AS train_loss,
            arg_max(eval_loss, step) FILTER (WHERE eval_loss IS NOT NULL) AS eval_loss, max(step) AS total_steps,
            {rnd("(epoch_us(max(ts)) - epoch_us(min(ts))) / 1000000.0", 1)} AS total_time_s,
            round(sum(num_samples) / ((epoch_us(max(ts)) - epoch_us(min(ts))) / 1000000.0), 6) AS samples_per_second,
            'checkpoints/best/checkpoint-step-' || max(step) AS checkpoint_path
            FROM train_events GROUP BY run_id""",
    ),
    "run_reports": with_(
        "train_events",
        body="""SELECT run_id, 'Training Results:' AS title,
            '  Checkpoint: checkpoints/best/checkpoint-step-' || max(step) AS checkpoint FROM train_events GROUP BY run_id""",
    ),
    "run_report_texts": with_(
        "train_events",
        body="""SELECT run_id, 'Training Results:' || coalesce(chr(10) || '  Training time: ' || format('{:.1f}', seconds) || 's', '')
            || chr(10) || '  Checkpoint: checkpoints/best/checkpoint-step-' || last_step
            || coalesce(chr(10) || '  Train loss: ' || format('{:.4f}', train_loss), '')
            || coalesce(chr(10) || '  Eval loss: ' || format('{:.4f}', eval_loss), '')
            || coalesce(chr(10) || '  Samples/sec: ' || format('{:.1f}', CASE WHEN seconds > 0 THEN samples / seconds END), '') AS summary
            FROM (SELECT run_id, arg_max(loss, step) FILTER (WHERE loss IS NOT NULL) AS train_loss,
                arg_max(eval_loss, step) FILTER (WHERE eval_loss IS NOT NULL) AS eval_loss, max(step) AS last_step,
                sum(num_samples) AS samples, (epoch_us(max(ts)) - epoch_us(min(ts))) / 1000000.0 AS seconds
                FROM train_events GROUP BY run_id)""",
    ),
    "batch_generation": with_(
        "unified",
        body=f"""SELECT row_id, prompt, 'Answer: ' || prompt AS generated_text,
            len({toks("'Answer: ' || prompt")}) AS num_tokens
            FROM (SELECT row_id, {TEXTS['chatml']['inference']} AS prompt FROM unified)""",
    ),
    "throughput": with_(
        "usage",
        body="""SELECT *, round(CASE WHEN generation_time <= 0 THEN 0.0 ELSE num_tokens / generation_time END, 6) AS tokens_per_second
            FROM (SELECT count(*) AS num_prompts, CAST(sum(usage_id) AS BIGINT) AS num_tokens,
                round(sum(CASE WHEN usage_id % 7 = 0 THEN 0.0 ELSE hours END), 6) AS generation_time FROM usage)""",
    ),
    "row_throughput": with_(
        "usage",
        body="""SELECT usage_id, round(CASE WHEN usage_id % 7 = 0 OR hours <= 0 THEN 0.0 ELSE usage_id / hours END, 6)
            AS tokens_per_second FROM usage""",
    ),
    "generate_and_score": with_("turns_unified", "echoed", "grams", "lcs", body=MEANS),
    "generate_and_check": with_(
        "turns_unified",
        body=f"""SELECT round(avg(CASE WHEN {ACCURACY_HIT} THEN 1.0 ELSE 0.0 END), 6) AS accuracy, count(*) AS n
            FROM (SELECT 'Answer: ' || instruction AS generated_text,
                CASE WHEN row_id % 2 = 0 THEN substr(instruction, 2, 12) ELSE output END AS expected FROM turns_unified)""",
    ),
    "stream_scoring": with_(
        "unified",
        body=f"""SELECT row_id, prompt, 'Answer: ' || prompt AS generated_text,
            len({toks("'Answer: ' || prompt")}) AS num_tokens
            FROM (SELECT row_id, {TEXTS['chatml']['inference']} AS prompt FROM unified)""",
    ),
    "review_samples": with_("turns_unified", "sampled", body="SELECT *, CAST(0.7 AS DOUBLE) AS temperature FROM sampled"),
    "loss_scoring": with_(
        "unified",
        body=f"""SELECT round(exp(sum(loss * num_tokens) / sum(num_tokens)), 6) AS perplexity, CAST(sum(num_tokens) AS BIGINT) AS total_tokens
            FROM (SELECT avg(length(text) % 7) AS loss, sum(least(len({toks('text')}), 2048)) AS num_tokens
                FROM (SELECT {TEXTS['llama3']['train']} AS text, (row_number() OVER (ORDER BY row_id) - 1) // 4 AS batch FROM unified)
                GROUP BY batch)""",
    ),
    "cost_estimate": with_(
        "usage",
        body=f"""SELECT usage_id, usage.instance_type, hours, coalesce(price, 0.0) AS hourly_cost_usd,
            {rnd("coalesce(price, 0.0) * hours", 2)} AS total_cost_usd, price IS NOT NULL AS known_pricing
            FROM usage LEFT JOIN (VALUES {PRICES}) AS p(instance_type, price) ON usage.instance_type = p.instance_type""",
    ),
    "prepare_dataset": with_(
        "unified", "flagged",
        body=split_sql(f"(SELECT row_id, {TEXTS['alpaca']['train']} AS text FROM {KEPT})", "row_id, text", 0.1, 0.5, 42),
    ),
    "prepare_training_sizes": with_(
        "unified", "flagged",
        body=f"SELECT split, count(*) AS n FROM ({split_sql(KEPT, 'row_id', 0.1, 0.0, 42)}) GROUP BY split",
    ),
    "prepare_training_rows": with_(
        "unified", "flagged",
        body=split_sql(f"(SELECT row_id, {TEXTS['llama3']['train']} AS text FROM {KEPT})", "row_id, text", 0.1, 0.0, 42),
    ),
    "prepare_reasons": with_("unified", "flagged", body="SELECT reason, count(*) AS n FROM flagged GROUP BY reason"),
    "evaluate_model": with_(
        "pairs", "grams", "lcs", "scored", "turns_unified", "answers",
        body=f"""SELECT 0 AS pos, 'stub' AS model_name, 'conversations' AS dataset_name,
                (SELECT count(*) FROM turns_unified) AS num_samples, m.no AS metric_no, m.name AS metric,
                round(CASE m.no WHEN 0 THEN ppl WHEN 1 THEN bleu WHEN 2 THEN rouge_1 WHEN 3 THEN rouge_2
                    WHEN 4 THEN rouge_l ELSE acc END, 6) AS value
            FROM ({MEANS}),
                (SELECT exp(sum(loss * num_tokens) / sum(num_tokens)) AS ppl FROM scored),
                (SELECT avg(CASE WHEN {ACCURACY_HIT} THEN 1.0 ELSE 0.0 END) AS acc FROM answers),
                (VALUES (0, 'perplexity'), (1, 'bleu'), (2, 'rouge_1'), (3, 'rouge_2'), (4, 'rouge_l'), (5, 'accuracy')) AS m(no, name)""",
    ),
    "compare_models": with_(
        "results",
        body="""SELECT metric, model_name, value FROM results QUALIFY row_number() OVER (PARTITION BY metric
            ORDER BY CASE WHEN metric IN ('perplexity', 'loss', 'eval_loss') THEN value ELSE -value END, pos) = 1""",
    ),
}

_CHAT = f"""chat AS (SELECT * FROM turns_unified), unified AS (SELECT *, '' AS source FROM chat)"""
ORACLES["chat_training_rows"] = (
    "WITH " + VIEWS["turns_unified"] + ", " + _CHAT + ", " + VIEWS["flagged"]
    + f" SELECT row_id AS conv_id, {TEXTS['chatml']['train']} AS text FROM flagged WHERE reason IS NULL"
)

_LINES = """SELECT 0 AS part, 0 AS pos, unnest([0, 1, 2, 3]) AS no, unnest(['Model Comparison Report:', '  Dataset: events',
        '  Models compared: ' || (SELECT count(DISTINCT pos) FROM results), '']) AS line
    UNION ALL SELECT DISTINCT 1, pos, -1, '  ' || model_name || ':' FROM results
    UNION ALL SELECT 1, pos, metric_no, format('    {}: {:.4f}', metric, value) FROM results
    UNION ALL SELECT DISTINCT 1, pos, 2147483647, '' FROM results
    UNION ALL SELECT 2, 0, 0, '  Best perplexity: ' || (SELECT model_name FROM results WHERE metric = 'perplexity' ORDER BY value, pos LIMIT 1)
    UNION ALL SELECT 2, 0, 1, format('  Perplexity change: {:+.2f} ({:+.1f}%)', b.value - a.value, 100 * (b.value - a.value) / a.value)
        FROM results a, results b WHERE a.metric = 'perplexity' AND b.metric = 'perplexity' AND a.pos = 0 AND b.pos = 4"""
ORACLES["comparison_report"] = with_("results", body=_LINES)


def _only_body(name: str) -> str:
    """A query on the result view without its leading definition of the view."""
    return ORACLES[name].removeprefix("WITH " + VIEWS["results"] + " ")


ORACLES["compare_models_tables"] = with_(
    "results",
    body=f"""SELECT 'best' AS part, model_name AS name, metric, value AS v1, NULL::DOUBLE AS v2, NULL::DOUBLE AS v3, NULL::DOUBLE AS v4, NULL AS text
            FROM ({_only_body("best_models")})
        UNION ALL SELECT 'improvement', NULL, metric, base_value, finetuned_value, absolute_change, relative_change, NULL FROM ({_only_body("improvement")})
        UNION ALL SELECT 'report', model_name, NULL, pos, NULL, NULL, NULL, summary FROM ({_only_body("evaluation_summaries")})
        UNION ALL SELECT 'summary', NULL, NULL, part, pos, no, NULL, line FROM ({_LINES})""",
)
