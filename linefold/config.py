"""Job specs: input line layout, summary query, Kafka source.

Plain frozen dataclasses. They are compiled once on the driver into column
expressions (``operators.parse``) and reader options (``sources.kafka``);
nothing here touches data.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, field

# ---------------------------------------------------------------------------
# The transaction-log layout these jobs were written for.
# 60 pipe-separated fields, 1-based; names as declared for the layout (the
# leading spaces some of them carry in the original declaration are trimmed).
# ---------------------------------------------------------------------------
TRANSACTION_FIELD_NAMES = (
    "id,time_stamp,sp_id,service_provider,app_id,app_name,state_app,"
    "source_entity_address,source_entity_masked,channel_type,source_protocol,"
    "dest_address,dest_masked,dest_channel_type,dest_protocol,travel_direction,"
    "ncs,billing,part_entity_type,charge_amount,currency,exchange_rates,"
    "charging_service_code,msisdn,masked_msisdn,billing_event,response_code,"
    "response_desc,transaction_state,transaction_keyword,col_31,col_32,col_33,"
    "col_34,col_35,col_36,col_37,col_38,col_39,col_40,col_41,col_42,col_43,"
    "col_44,col_45,col_46,col_47,col_48,col_49,col_50,col_51,col_52,col_53,"
    "col_54,col_55,col_56,col_57,col_58,col_59,col_60"
)
TRANSACTION_FIELD_COUNT = 60
TRANSACTION_DELIMITER = "|"
# selected field -> (1-based field number, [begin, end) slice or None)
TRANSACTION_SELECTED = (
    ("time_stamp", 2, (0, 10)),
    ("app_id", 5, None),
    ("channel_type", 10, None),
    ("travel_direction", 16, None),
)
TRANSACTION_PREDICATE = "channel_type = 'sms' AND travel_direction = 'mo'"
TRANSACTION_KEYS = ("time_stamp", "app_id")
SUMMARY_TABLE = "daily_summary"
STAGING_TABLE = "temp_view"
# ---------------------------------------------------------------------------


def _split_names(names: str | Iterable[str], sep: str = ",") -> tuple[str, ...]:
    if isinstance(names, str):
        names = names.split(sep)
    return tuple(n.strip() for n in names if n.strip())


def _flag(value) -> bool:
    """A boolean of a config, which may write it as a string."""
    if isinstance(value, str):
        word = value.strip().lower()
        if word not in ("true", "yes", "on", "false", "no", "off", ""):
            raise ValueError(f"not a boolean: {value!r}")
        return word in ("true", "yes", "on")
    return bool(value)


@dataclass(frozen=True)
class FieldSpec:
    """One projected field: ``name`` is taken from 1-based ``ordinal``.

    ``slice`` is an optional ``(begin, end)`` character range, 0-based and end
    exclusive. A value shorter than ``end`` cannot be sliced; the parser routes
    such a line to the rejects (or fails, in ``failfast`` mode).
    """

    name: str
    ordinal: int
    slice: tuple[int, int] | None = None

    def __post_init__(self):
        if self.ordinal < 1:
            raise ValueError(f"{self.name}: field ordinals are 1-based, got {self.ordinal}")
        if self.slice is not None:
            begin, end = self.slice
            if not 0 <= begin <= end:
                raise ValueError(f"{self.name}: bad slice {self.slice}")


@dataclass(frozen=True)
class LogSpec:
    """Layout of a delimited log line."""

    fields: tuple[FieldSpec, ...]
    delimiter: str = TRANSACTION_DELIMITER
    field_count: int = TRANSACTION_FIELD_COUNT
    field_names: tuple[str, ...] = ()

    def __post_init__(self):
        if not self.delimiter:
            raise ValueError("delimiter must be non-empty")
        names = [f.name for f in self.fields]
        if len(set(names)) != len(names):
            raise ValueError(f"duplicate field names in {names}")
        for f in self.fields:
            if f.ordinal > self.field_count:
                raise ValueError(f"{f.name}: ordinal {f.ordinal} > field_count {self.field_count}")

    @property
    def names(self) -> list[str]:
        return [f.name for f in self.fields]

    @property
    def max_ordinal(self) -> int:
        return max(f.ordinal for f in self.fields)

    def ordinal_of(self, name: str) -> int:
        """1-based position of a declared field name."""
        return self.field_names.index(name) + 1

    def select(self, *names: str, slices: Mapping[str, tuple[int, int]] | None = None) -> LogSpec:
        """The same layout with these declared field names selected (ordinals looked up).

        ``slices`` optionally maps a name to its ``(begin, end)`` slice.
        """
        slices = slices or {}
        missing = [n for n in names if n not in self.field_names]
        if missing:
            raise ValueError(f"not declared in this layout: {missing}")
        fields = tuple(FieldSpec(n, self.ordinal_of(n), slices.get(n)) for n in names)
        return LogSpec(fields, self.delimiter, self.field_count, self.field_names)

    def with_fields(self, *extra: FieldSpec) -> LogSpec:
        return LogSpec(self.fields + tuple(extra), self.delimiter, self.field_count, self.field_names)

    @classmethod
    def transaction_log(cls) -> LogSpec:
        """The transaction-log layout: four selected fields out of 60."""
        return cls(
            fields=tuple(FieldSpec(n, o, s) for n, o, s in TRANSACTION_SELECTED),
            delimiter=TRANSACTION_DELIMITER,
            field_count=TRANSACTION_FIELD_COUNT,
            field_names=_split_names(TRANSACTION_FIELD_NAMES),
        )

    @classmethod
    def from_dict(cls, conf: Mapping) -> LogSpec:
        """Build from an ``input { ... }`` config block converted to a dict.

        Accepts the original key names (``fieldCount``, ``delimeter``,
        ``fields``, ``selectedFields`` and per-field ``fieldNumber``,
        ``substring``, ``substringValue``) as well as snake_case ones.
        """
        delim = conf.get("delimiter", conf.get("delimeter", TRANSACTION_DELIMITER))
        count = int(conf.get("field_count", conf.get("fieldCount", TRANSACTION_FIELD_COUNT)))
        sep = conf.get("fieldSeperator", ",")
        names = _split_names(conf.get("fields", conf.get("field_names", ())), sep)
        selected = conf.get("selectedFields", conf.get("selected_fields", ()))
        fields = []
        for raw in selected:
            name = raw.strip()
            sub = conf.get(name, {})
            if "fieldNumber" in sub or "ordinal" in sub:
                ordinal = int(sub.get("fieldNumber", sub.get("ordinal")))
            else:
                ordinal = names.index(name) + 1
            cut = None
            if _flag(sub.get("substring", False)) or sub.get("slice"):
                begin, end = sub.get("substringValue", sub.get("slice"))
                cut = (int(begin), int(end))
            fields.append(FieldSpec(name, ordinal, cut))
        return cls(tuple(fields), delim, count, names)


@dataclass(frozen=True)
class SummarySpec:
    """What to count (C2) and where the summary lives."""

    predicate: str | None = TRANSACTION_PREDICATE
    keys: tuple[str, ...] = TRANSACTION_KEYS
    count_col: str = "count"
    table: str = SUMMARY_TABLE
    staging_table: str = STAGING_TABLE

    def __post_init__(self):
        if not self.keys:
            raise ValueError("at least one grouping key is required")
        object.__setattr__(self, "keys", tuple(self.keys))

    @classmethod
    def from_dict(cls, query: Mapping, output: Mapping | None = None) -> SummarySpec:
        output = output or {}
        keys = query.get("groupingFields", query.get("keys", TRANSACTION_KEYS))
        keys = _split_names(keys) if isinstance(keys, str) else tuple(k.strip() for k in keys)
        return cls(
            predicate=query.get("whereClause", query.get("predicate", TRANSACTION_PREDICATE)),
            keys=keys,
            count_col=cls._count_column(output, keys),
            table=output.get("tableName", output.get("table", SUMMARY_TABLE)),
            staging_table=output.get("temporyView", output.get("staging_table", STAGING_TABLE)),
        )

    @staticmethod
    def _count_column(output: Mapping, keys: Sequence[str]) -> str:
        """The count's column: the one after the keys in the output's column list and in its DDL.

        A list or DDL that is not the keys in their order and one more column is an error, as the job could
        not fill such a table.
        """
        named = set()
        if "count_col" in output:
            named.add(output["count_col"])
        lists = []
        if output.get("columnNames"):
            raw = output["columnNames"]
            lists.append(_split_names(raw) if isinstance(raw, str) else tuple(c.strip() for c in raw))
        if output.get("createTableQuery"):
            ddl = output["createTableQuery"]  # a column list, alone or in a CREATE TABLE statement
            inner = re.search(r"\((.*)\)", ddl, re.DOTALL)
            parts = [c.split() for c in (inner[1] if inner else ddl).split(",")]
            lists.append(tuple(c[0].strip("`") for c in parts if c))
        for columns in lists:
            if columns[:-1] != tuple(keys):
                raise ValueError(f"output columns {columns} are not the keys {tuple(keys)} and a count")
            named.add(columns[-1])
        if len(named) > 1:
            raise ValueError(f"the output names several count columns: {sorted(named)}")
        return named.pop() if named else "count"


@dataclass(frozen=True)
class KafkaSpec:
    """Kafka source settings (C4), mapped to Spark's Kafka source options.

    Spark keeps consumed offsets in the query checkpoint and never commits
    them to Kafka, so ``enable.auto.commit=false`` needs no option; the
    ``auto.offset.reset`` of a plain consumer becomes ``startingOffsets``.
    """

    bootstrap_servers: str
    topics: str | Sequence[str] = ()
    group_id: str | None = None
    starting_offsets: str = "latest"
    topic_separator: str = ","
    extra: Mapping[str, str] = field(default_factory=dict)

    def topic_set(self) -> list[str]:
        """Distinct topic names, in first-seen order."""
        raw = self.topics.split(self.topic_separator) if isinstance(self.topics, str) else self.topics
        seen: dict[str, None] = {}
        for t in raw:
            t = t.strip()
            if t:
                seen.setdefault(t, None)
        return list(seen)

    def _common(self) -> dict[str, str]:
        opts = {"kafka.bootstrap.servers": self.bootstrap_servers}
        if self.group_id:
            opts["kafka.group.id"] = self.group_id
        opts.update({k: str(v) for k, v in self.extra.items()})
        return opts

    def subscribe_options(self) -> dict[str, str]:
        """Options for ``readStream.format("kafka")`` subscribing to the topic set."""
        topics = self.topic_set()
        if not topics:
            raise ValueError("no topics to subscribe to")
        opts = self._common()
        opts["subscribe"] = ",".join(topics)
        opts["startingOffsets"] = self.starting_offsets
        return opts

    def assign_options(self, from_offsets: Mapping[tuple[str, int], int]) -> dict[str, str]:
        """Options reading assigned partitions from explicit offsets.

        ``from_offsets`` maps ``(topic, partition)`` to the first offset to read.
        """
        import json

        if not from_offsets:
            raise ValueError("no partitions assigned")
        assign: dict[str, list[int]] = {}
        start: dict[str, dict[str, int]] = {}
        for (topic, part), off in sorted(from_offsets.items()):
            assign.setdefault(topic, []).append(int(part))
            start.setdefault(topic, {})[str(int(part))] = int(off)
        opts = self._common()
        opts["assign"] = json.dumps(assign, sort_keys=True)
        opts["startingOffsets"] = json.dumps(start, sort_keys=True)
        return opts

    @classmethod
    def from_dict(cls, conf: Mapping) -> KafkaSpec:
        return cls(
            bootstrap_servers=conf.get("bootstrapServers", conf.get("bootstrap_servers", "")),
            topics=conf.get("topicSet", conf.get("topics", ())),
            group_id=conf.get("groupId", conf.get("group_id")),
            topic_separator=conf.get("topicSetSeperator", conf.get("topic_separator", ",")),
            starting_offsets=conf.get("startingOffsets", conf.get("starting_offsets", "latest")),
            extra=dict(conf.get("options", conf.get("extra", {}))),
        )
