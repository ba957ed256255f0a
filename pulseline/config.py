"""Run configuration for the sensor programs (host/port or folder, filter
terms, base value, key columns, trigger, checkpoint)."""

from __future__ import annotations

from dataclasses import dataclass, field, fields

# Fixed values that must equal the reference program's defaults.
DEFAULT_FILTER_TERMS = ("HR DAILY", "MEASUREMENT", "SUMMARY (MEAN) HEART RATE")
DEFAULT_BASE_VALUE = 50
DEFAULT_ALERT_THRESHOLD = 10
DEFAULT_SEPARATOR = "|"
DEFAULT_KEY_COLUMNS = ("trial_id", "patient_id", "visit_name")
DEFAULT_TRIGGER = "10 seconds"
DEFAULT_WORD_SEED = (("hello", 1), ("world", 1))


@dataclass(frozen=True)
class SensorConfig:
    source: str = "folder"            # "folder" | "socket"
    path: str | None = None           # folder of line files
    host: str = "localhost"
    port: int = 9999
    separator: str = DEFAULT_SEPARATOR
    filter_terms: tuple[str, ...] = DEFAULT_FILTER_TERMS
    base_value: int = DEFAULT_BASE_VALUE
    alert_threshold: int = DEFAULT_ALERT_THRESHOLD
    key_columns: tuple[str, ...] = DEFAULT_KEY_COLUMNS
    trigger: str = DEFAULT_TRIGGER
    field_terms: dict[int, str] = field(default_factory=dict)  # field number -> its whole text
    max_files_per_trigger: int | None = None
    max_bytes_per_trigger: int | None = 1 << 30  # of a folder stream, if files are not limited
    checkpoint: str | None = None

    @classmethod
    def from_dict(cls, d: dict) -> "SensorConfig":
        known = {f.name for f in fields(cls)}
        unknown = sorted(set(d) - known)
        if unknown:
            raise ValueError(f"unknown settings: {', '.join(unknown)}")
        kw = dict(d)
        for k in ("filter_terms", "key_columns"):
            if k in kw:
                kw[k] = tuple(kw[k])
        if "field_terms" in kw:
            kw["field_terms"] = {int(k): v for k, v in kw["field_terms"].items()}
        return cls(**kw)
