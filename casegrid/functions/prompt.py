"""Per-row classifier prompt, rendered with native string expressions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from casegrid.functions._util import to_col

# Prompt version tag, narrative field order (also the order of
# the content hash), field labels, defaults and the closing instruction.
PROMPT_VERSION = "v1"
NARRATIVE_FIELDS: tuple[str, ...] = (
    "narrative_location",
    "narrative_description",
    "narrative_activity",
    "narrative_event",
    "narrative_injury",
    "narrative_source",
)
NARRATIVE_LABELS: dict[str, str] = {
    "narrative_location": "Where it happened",
    "narrative_description": "Incident description",
    "narrative_activity": "What the employee was doing",
    "narrative_event": "What happened",
    "narrative_injury": "Injury or illness",
    "narrative_source": "Object or substance involved",
}
SECTOR_DEFAULT = "unknown"
FIELD_DEFAULT = "(not provided)"
CLOSING_LINE = "Classify this incident by calling the classification tool with every field populated."

# The instruction part of a request, sent with every prompt.
INSTRUCTIONS = (
    "You read one report of a workplace incident and answer in a fixed form.\n"
    "State the main cause in a short phrase, taken from the report and not guessed.\n"
    "Choose the tier by the harm that the report describes, not by how long it is.\n"
    "Choose one event category from the list; if none fits, choose 'other'.\n"
    "Name one concrete step that would keep this from happening again.\n"
    "Give a confidence between 0 and 1. If the report says too little to decide, answer 'other' "
    "with a low confidence instead of inventing details."
)


def _or_default(c: Column, default: str) -> Column:
    # Python's ``value or default``: null and '' both take the default
    return F.coalesce(F.nullif(c, F.lit("")), F.lit(default))


def render_prompt(fields: Sequence[str] | Mapping[str, str] = NARRATIVE_FIELDS,
                  sector=None, labels: Mapping[str, str] = NARRATIVE_LABELS) -> Column:
    """``Industry: ..`` line, a blank line, a heading, one ``- label: value``
    line per field, a blank line, the closing instruction; joined by '\\n'.

    ``fields`` may map prompt field names to the DataFrame columns holding them.
    """
    mapping = dict(fields) if isinstance(fields, Mapping) else {f: f for f in fields}
    sector_col = to_col(sector) if sector is not None else F.lit(None).cast("string")
    lines = [
        F.concat(F.lit("Industry: "), _or_default(sector_col, SECTOR_DEFAULT)),
        F.lit(""),
        F.lit("Incident narrative:"),
    ]
    for name, src in mapping.items():
        lines.append(F.concat(F.lit(f"- {labels[name]}: "), _or_default(to_col(src), FIELD_DEFAULT)))
    lines += [F.lit(""), F.lit(CLOSING_LINE)]
    return F.concat_ws("\n", *lines)
