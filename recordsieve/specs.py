"""What a record of each kind looks like: columns, types, reject rules.

Everything else in the package is generic and driven by these two specs.
"""

from __future__ import annotations

from dataclasses import dataclass

BAD_LINES = "bad_lines"
OFF_TOPIC = "not_interest_subreddit"
BOTS = "bots"
DELETED_AUTHOR = "[deleted]"

# Column groups. Each group has one coercion, see operators/project.py.
RAW = "raw"  # passed through, NULL kept
STRING = "string"  # NULL -> ''
TEXT = "text"  # newlines flattened, NULL -> ''
ENUM = "enum"  # NULL -> 'none'
TIMESTAMP = "timestamp"  # epoch seconds -> UTC
BOOLEAN = "boolean"
BIGINT = "bigint"
DOUBLE = "double"
JSON = "json"  # nested value as JSON text, falsy -> 'null'


@dataclass(frozen=True)
class Rule:
    """One reject rule: ``test`` over any of ``fields`` gives ``reason``."""

    reason: str
    test: str  # present | truthy | is_true
    fields: tuple[str, ...]


@dataclass(frozen=True)
class RecordSpec:
    kind: str
    columns: tuple[tuple[str, str], ...]
    rules: tuple[Rule, ...]
    reasons: tuple[str, ...]  # order of the report, all zero-filled

    @property
    def names(self) -> tuple[str, ...]:
        return tuple(name for name, _ in self.columns)

    @property
    def input_fields(self) -> tuple[str, ...]:
        """Output columns, then the fields only the rules look at."""
        extra = (f for rule in self.rules for f in rule.fields)
        return tuple(dict.fromkeys((*self.names, *extra)))

    def group(self, *groups: str) -> tuple[str, ...]:
        return tuple(name for name, g in self.columns if g in groups)


def _columns(table: str) -> tuple[tuple[str, str], ...]:
    return tuple(tuple(row.split()) for row in table.strip().splitlines())


# --- fixed values: output columns in output order, reasons in rule order ---

COMMENTS = RecordSpec(
    kind="comments",
    columns=_columns("""
        id raw
        author string
        author_fullname string
        author_is_blocked boolean
        author_premium boolean
        body text
        created_utc timestamp
        retrieved_on timestamp
        subreddit string
        subreddit_id raw
        subreddit_type raw
        score bigint
        ups bigint
        downs bigint
        total_awards_received bigint
        gilded bigint
        distinguished enum
        stickied boolean
        controversiality bigint
        permalink string
        parent_id raw
        link_id raw
        score_hidden boolean
        collapsed boolean
        collapsed_reason text
        collapsed_reason_code text
        no_follow boolean
        can_gild boolean
        can_mod_post boolean
        is_submitter boolean
        send_replies boolean
        archived boolean
        locked boolean
        name string
        saved boolean
        gildings json
        all_awardings json
        awarders json
        author_patreon_flair boolean
        likes boolean
        mod_reports json
        user_reports json
        report_reasons json
        num_reports bigint
        banned_at_utc timestamp
        approved_at_utc timestamp
        approved_by string
        associated_award text
        unrepliable_reason text
    """),
    rules=(
        Rule("banned", "present", ("banned_by",)),
        Rule("crowd_control", "truthy", ("collapsed_because_crowd_control",)),
        Rule("non_text", "present", ("comment_type",)),
        Rule("controversial", "is_true", ("controversiality",)),
        Rule("removed", "present", ("removed_by", "removed_by_category")),
    ),
    reasons=(
        OFF_TOPIC, BAD_LINES, BOTS,
        "banned", "crowd_control", "non_text", "controversial", "removed",
    ),
)

SUBMISSIONS = RecordSpec(
    kind="submissions",
    columns=_columns("""
        id raw
        author string
        author_fullname string
        author_is_blocked boolean
        title text
        selftext text
        created_utc timestamp
        retrieved_on timestamp
        subreddit string
        subreddit_id raw
        subreddit_type raw
        score bigint
        ups bigint
        downs bigint
        upvote_ratio double
        num_comments bigint
        total_awards_received bigint
        gilded bigint
        distinguished enum
        stickied boolean
        is_self boolean
        is_video boolean
        is_original_content boolean
        locked boolean
        name string
        saved boolean
        spoiler boolean
        gildings json
        all_awardings json
        awarders json
        media_only boolean
        can_gild boolean
        contest_mode boolean
        no_follow boolean
        author_premium boolean
        author_patreon_flair boolean
        author_flair_text text
        num_crossposts bigint
        pinned boolean
        permalink string
        url string
        category text
        hide_score boolean
        media json
        media_metadata json
        secure_media json
    """),
    rules=(
        Rule("quarantine", "is_true", ("quarantine",)),
        Rule("banned", "present", ("banned_by",)),
        Rule("removed", "present", ("removed_by",)),
        Rule("removed_category", "present", ("removed_by_category",)),
        Rule("over_18", "is_true", ("over_18",)),
    ),
    # author_blocked is reported but no rule gives it, so it is always 0.
    reasons=(
        OFF_TOPIC, BAD_LINES, BOTS,
        "quarantine", "author_blocked", "banned", "removed", "removed_category", "over_18",
    ),
)

# --- end of fixed values ---

SPECS = {spec.kind: spec for spec in (COMMENTS, SUBMISSIONS)}
