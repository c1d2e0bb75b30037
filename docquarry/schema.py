"""Schemas of the corpus tables, and the values a verdict may have."""

from __future__ import annotations

from pyspark.sql import types as T

#: Verdicts, and those that count as yes and no.
MATCHES = ("yes", "maybe", "no", "1", "0")
YES, MAYBE, NO = ("yes", "1"), ("maybe",), ("no", "0")


def _fields(spec: str) -> T.StructType:
    """``name type`` pairs; ``!`` after a type means NOT NULL."""
    out = []
    for part in spec.split(","):
        name, kind = part.split()
        out.append(T.StructField(name, T._parse_datatype_string(kind.rstrip("!")), not kind.endswith("!")))
    return T.StructType(out)


def tables() -> dict[str, T.StructType]:
    """The corpus tables by name (needs a running session to parse types)."""
    return {
        "result": _fields("result_id bigint!, filepath string!, content string!, content_sha256 string!, part_number int, parent_result_id bigint, created_at timestamp"),
        "category": _fields("category_id bigint!, category_filename string!, category_name string!, category_description string!, prompt_sha256 string!, created_at timestamp"),
        "result_category": _fields("result_id bigint!, category_id bigint!, match string!, reasoning_trace string, created_at timestamp"),
        "result_category_blockquote": _fields("blockquote_id bigint!, result_id bigint!, category_id bigint!, blockquote string!, created_at timestamp"),
        "excluded_file": _fields("filepath string!, reason string!, content_sha256 string, excluded_at timestamp"),
        "run_stats": _fields(
            "run_id bigint!, started_at timestamp!, finished_at timestamp, model string!, pairs_processed bigint, pairs_saved bigint, pairs_failed bigint, pairs_skipped bigint, "
            "processing_seconds double, janitor_imported bigint, janitor_seconds double, hostname string, notes string"
        ),
    }
