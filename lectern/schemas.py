"""Table schemas and the small fixed dimensions shared by all operators."""

from __future__ import annotations

# ---------------------------------------------------------------------------
# Fixed values (must equal what existing users' data and reports rely on)
# ---------------------------------------------------------------------------

STAGES = ("s01", "s02", "s03", "s04", "s05", "s06", "s07", "s08", "s09", "s10")

STAGE_STATUSES = ("pending", "running", "success", "failed", "skipped", "dry_run")
RUN_STATUSES = ("queued", "running", "completed", "failed", "dry_run")

MEDIA_EXTENSIONS = (
    "aac", "aif", "aiff", "flac", "m4a", "m4b", "mka", "mp3",
    "mp4", "oga", "ogg", "opus", "wav", "webm", "wma",
)

# (model prefix, USD per million input tokens, USD per million output tokens);
# the first prefix that matches wins.
MODEL_PRICES = (
    ("gpt-5-nano", 0.05, 0.40),
    ("gpt-5-mini", 0.25, 2.00),
    ("gpt-5.2", 1.75, 14.00),
)
DEFAULT_PRICE_IN = 0.25
DEFAULT_PRICE_OUT = 2.0

STAGE_OUTPUT_RATIO = {
    "s05": 0.95, "s06": 0.35, "s07": 0.80, "s08": 0.70, "s09": 1.05, "s10": 0.90,
}
DEFAULT_OUTPUT_RATIO = 0.8

PAID_PROVIDER = "openai"
LOCAL_PROVIDER = "local"

CHUNK_SECONDS = 30
TEXT_CHUNK_CHARS = 6000
SPAN_BATCH_SIZE = 40
SPAN_BATCH_CHARS = 8000
WINDOW_SIZE = 8
WINDOW_OVERLAP = 1
JSON_RETRIES = 3
COST_CAP_USD = 2.0
TOKEN_CAP_IN = 2_000_000
TOKEN_CAP_OUT = 1_000_000
MAX_CALLS_PER_STAGE = 10_000

# template name -> (stage label, holes it may use and should use)
TEMPLATE_CATALOG = {
    "s05_cleanup.txt": ("s05", ("text",)),
    "s06_classification.txt": ("s06", ("span_lines",)),
    "s06_repair_json.txt": ("s06", ("original_prompt", "bad_response")),
    "s07_editorial.txt": ("s07", ("text",)),
    "s08_condense_map.txt": ("s08", ("paragraph_lines",)),
    "s08_condense_reduce.txt": ("s08", ("candidate_blocks_json",)),
    "s09_translate.txt": ("s09", ("text",)),
    "s10_czech_editorial.txt": ("s10", ("text",)),
}
# template key -> older file names still honoured inside the same root
LEGACY_TEMPLATE_NAMES = {
    "s09_translate.txt": ("s08_translate.txt",),
    "s10_czech_editorial.txt": ("s09_czech_editorial.txt",),
}

# ---------------------------------------------------------------------------
# Schemas, as DDL so that importing needs no running session
# ---------------------------------------------------------------------------

CHUNK_ROW = (
    "id INT, start_time DOUBLE, end_time DOUBLE, filename STRING, sha256 STRING"
)
TRANSCRIPT_INDEX_ROW = (
    "id INT, chunk_filename STRING, start_time DOUBLE, end_time DOUBLE, "
    "txt_filename STRING, srt_filename STRING"
)
BLOCK_ROW = (
    "from_paragraph INT, to_paragraph INT, title STRING, body STRING"
)
CALLS = (
    "run_id STRING, stage STRING, phase STRING, batch_id INT, retry_index INT, "
    "provider STRING, model STRING, temperature DOUBLE, prompt_hash STRING, "
    "prompt STRING, response STRING, input_chars BIGINT, output_chars BIGINT, "
    "in_tok BIGINT, out_tok BIGINT, cost_usd DOUBLE, cum_cost_usd DOUBLE, "
    "parse_error STRING"
)
ARTIFACT = ("path STRING, sha256 STRING, bytes BIGINT")
MANIFEST = (
    "stage STRING, status STRING, started_at STRING, finished_at STRING, "
    "params MAP<STRING,STRING>, "
    "inputs ARRAY<STRUCT<path: STRING, sha256: STRING, bytes: BIGINT>>, "
    "outputs ARRAY<STRUCT<path: STRING, sha256: STRING, bytes: BIGINT>>, "
    "commands ARRAY<STRING>, tool_versions MAP<STRING,STRING>, "
    "llm_calls ARRAY<STRUCT<model: STRING, temperature: DOUBLE, prompt_hash: STRING, "
    "input_chars: BIGINT, output_chars: BIGINT, retries: INT>>, "
    "errors ARRAY<STRING>, dry_run BOOLEAN"
)
EVENTS = (
    "ts TIMESTAMP, seq BIGINT, event STRING, audio_path STRING, run_dir STRING, "
    "run_index INT, total_runs INT, stage STRING, resource STRING, status STRING, "
    "message STRING, task_label STRING"
)
EDITS = ("chunk_id INT, before STRING, after STRING, diff ARRAY<STRING>")
REMOVED_SPANS = ("span_id INT, label STRING, reason STRING, text STRING")
