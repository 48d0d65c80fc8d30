"""Field mapping: rules over column names, resolved on the schema into one projection."""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StringType, StructType, TimestampNTZType, TimestampType

from tidemark.functions.scalars import iso, make_id, regex_group

OPERATIONS = ("copy", "move", "delete", "keep")


@dataclass(frozen=True)
class Rule:
    """`source` is a name, or a pattern between slashes whose groups `target` may use as $1, $2 ..."""

    source: str
    target: str | None = None
    operation: str = "copy"

    def __post_init__(self) -> None:
        if self.operation not in OPERATIONS:
            raise ValueError(f"unknown operation {self.operation!r}")
        if self.operation in ("copy", "move") and not self.target:
            raise ValueError(f"{self.operation} of {self.source!r} needs a target")

    @property
    def is_pattern(self) -> bool:
        return len(self.source) > 1 and self.source.startswith("/") and self.source.endswith("/")

    def match(self, name: str) -> str | None:
        """The target name if this rule applies to `name` (the name itself where no target is needed)."""
        if self.is_pattern:
            found = re.search(self.source[1:-1], name)
            if not found:
                return None
            if not self.target:
                return name
            return re.sub(r"\$(\d)", lambda m: found.group(int(m.group(1))) or "", self.target)
        return (self.target or name) if self.source == name else None


def _quoted(path: Sequence[str]) -> str:
    return ".".join("`" + part.replace("`", "``") + "`" for part in path)


def flat_fields(schema: StructType, prefix: tuple[str, ...] = ()) -> list[tuple[str, Column, DataType]]:
    """Leaf fields as (dotted name, column, type). Structs are opened, arrays and maps are not."""
    out = []
    for f in schema.fields:
        path = (*prefix, f.name)
        if isinstance(f.dataType, StructType):
            out.extend(flat_fields(f.dataType, path))
        else:
            out.append((".".join(path), F.col(_quoted(path)), f.dataType))
    return out


def map_fields(
    df: DataFrame, rules: Sequence[Rule], unmapped: Rule | None = None, multi_valued: Sequence[str] = ("_ss", "_lat_lon")
) -> DataFrame:
    """Apply `rules` in order to the columns of `df`; nested fields are addressed as `parent.child`.

    copy    the target gets the source's value, the source stays
    move    the same, and the source goes
    delete  the source goes
    keep    the source stays as it is and counts as mapped
    A pattern applies to input fields only, not to targets that earlier rules have made.
    `unmapped` is applied at the end to each input field that no rule matched.

    Several sources with one target: the first that is not null, in rule order. A value that is already
    in the target comes first. A target whose name ends in one of `multi_valued` takes all values instead,
    as a list without nulls in rule order. If the types differ, the target is text. The definition of these
    merges is this library's own.
    """
    fields: dict[str, list[tuple[Column, DataType]]] = {n: [(c, t)] for n, c, t in flat_fields(df.schema)}
    inputs = list(fields)
    touched: set[str] = set()

    def run(rule: Rule, name: str) -> bool:
        target = rule.match(name)
        if target is None:
            return False
        if rule.operation == "delete":
            fields.pop(name, None)
        elif rule.operation in ("copy", "move") and target != name:
            values = fields[name]
            if rule.operation == "move":
                fields.pop(name)
            fields.setdefault(target, []).extend(values)
            touched.add(target)
        return True

    for rule in rules:
        for name in list(fields):
            if (name in inputs or not rule.is_pattern) and run(rule, name):
                touched.add(name)
    if unmapped is not None:
        for name in inputs:
            if name in fields and name not in touched:
                run(unmapped, name)

    return df.select(
        *[_merge(values, name.endswith(tuple(multi_valued))).alias(name) for name, values in fields.items()]
    )


def _merge(values: list[tuple[Column, DataType]], keep_all: bool) -> Column:
    if len(values) == 1:
        return values[0][0]
    mixed = len({t.simpleString() for _, t in values}) > 1
    cols = [c.cast("string") if mixed else c for c, _ in values]
    return F.array_compact(F.array(*cols)) if keep_all else F.coalesce(*cols)


# Type suffixes of column names; a list has the doubled letter. Short, byte and decimal numbers are
# widened to the type of their suffix.
_SUFFIX = {
    "string": "_s", "int": "_i", "smallint": "_i", "tinyint": "_i", "bigint": "_l", "double": "_d", "decimal": "_d", "float": "_f",
    "boolean": "_b", "timestamp": "_tdt", "timestamp_ntz": "_tdt", "date": "_tdt",
}
_WIDENED = {"smallint": "int", "tinyint": "int", "decimal": "double"}
_TEXT_SUFFIXES = ("_s", "_t", "_txt", "_txt_en", "_lat_lon")


def _kind(kind: DataType) -> str:
    return kind.typeName() if kind.typeName() == "decimal" else kind.simpleString()


def _has_suffix(name: str, kind: DataType) -> bool:
    """Whether the name ends in a suffix that fits the type."""
    if isinstance(kind, ArrayType):
        own = _SUFFIX.get(_kind(kind.elementType), "_s")
        return name.endswith((own + own[-1], "_txt", "_txt_en", "_lat_lon"))
    own = _SUFFIX.get(_kind(kind))
    return own is not None and name.endswith(_TEXT_SUFFIXES if own == "_s" else own)


def suffix_names(df: DataFrame, max_len: int = 100, exclude: Sequence[str] = ("id",)) -> DataFrame:
    """Name each column by its type. Text gives `<name>_t`, and `<name>_s` for values of at most `max_len`
    characters; a name that already ends in a suffix of its type stays. Structs, maps and lists of such become
    JSON text, and other types without a suffix plain text."""
    out = []
    for f in df.schema.fields:
        col, kind = F.col(_quoted([f.name])), f.dataType
        if f.name in exclude or _has_suffix(f.name, kind):
            out.append(col)
            continue
        nested = kind.elementType if isinstance(kind, ArrayType) else kind
        if _kind(nested) not in _SUFFIX:
            complex_type = isinstance(kind, (ArrayType, MapType, StructType))
            col, kind = F.to_json(col) if complex_type else col.cast("string"), StringType()
        if isinstance(kind, StringType):
            out.append(F.when(F.length(col) <= max_len, col).alias(f.name + "_s"))
            out.append(col.alias(f.name + "_t"))
        elif isinstance(kind, ArrayType):
            element = _kind(kind.elementType)
            wide = _WIDENED.get(element)
            suffix = _SUFFIX[element]
            out.append((col.cast(f"array<{wide}>") if wide else col).alias(f.name + suffix + suffix[-1]))
        else:
            wide = _WIDENED.get(_kind(kind))
            out.append((col.cast(wide) if wide else col).alias(f.name + _SUFFIX[_kind(kind)]))
    return df.select(*out)


def rename_select(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Give positional columns their names."""
    return df.toDF(*names)


def reshape(
    df: DataFrame,
    add: Mapping[str, Column] | None = None,
    drop: Sequence[str] = (),
    rename: Mapping[str, str] | None = None,
) -> DataFrame:
    """Add, drop and rename columns, in this order."""
    out = df.withColumns(dict(add)) if add else df
    out = out.drop(*drop)
    return out.withColumnsRenamed(dict(rename)) if rename else out


def with_row_id(df: DataFrame, name: str = "id") -> DataFrame:
    """Unique, not consecutive, row number; needs no shuffle."""
    return df.withColumn(name, F.monotonically_increasing_id())


def format_signals(
    df: DataFrame,
    params: str = "params",
    params_schema: str | None = None,
    allowed_types: Sequence[str] = (),
    undefined_type: str = "general",
) -> DataFrame:
    """Lift the fields of `params` (a struct, or JSON text with `params_schema`) to the top level; a signal
    without a type becomes `undefined_type`; with `allowed_types`, other types are left out."""
    nested = F.from_json(params, params_schema) if params_schema else F.col(params)
    out = df.withColumn(params, nested).withColumn("type", F.coalesce("type", F.lit(undefined_type)))
    if allowed_types:
        out = out.where(F.col("type").isin(*allowed_types))
    rest = [c for c in out.columns if c != params]
    return out.select(*rest, f"{params}.*")


def mark_clicks(df: DataFrame, item: str, group: str) -> DataFrame:
    """Rows that have both parts get `type_s` = click and `doc_id_s` = group-item; others get nulls."""
    both = F.col(item).isNotNull() & (F.col(item) != "") & F.col(group).isNotNull() & (F.col(group) != "")
    return df.withColumns(
        {"type_s": F.when(both, F.lit("click")), "doc_id_s": F.when(both, make_id([group, item], "-"))}
    )


@dataclass(frozen=True)
class Stage:
    """One step of a load pipeline; `skip` switches it off without taking it out."""

    label: str
    apply: Callable[[DataFrame], DataFrame]
    skip: bool = False


def run_stages(df: DataFrame, stages: Sequence[Stage]) -> DataFrame:
    """Ordered steps as one lazy plan: Spark fuses them, no step is stored."""
    for stage in stages:
        if not stage.skip:
            df = df.transform(stage.apply)
    return df


def regex_extract(
    df: DataFrame, source: str, pattern: str, group: int, target: str, on_no_match: str | None = None
) -> DataFrame:
    """Put one group of the first match into `target`, over what it held."""
    return df.withColumn(target, regex_group(source, pattern, group, on_no_match))


def to_pairs(df: DataFrame, exclude: Sequence[str] = ()) -> Column:
    """All columns of a row as a list of (name, value) without the nulls; instants become ISO text."""
    pairs = []
    for f in df.schema.fields:
        if f.name in exclude:
            continue
        col = F.col(_quoted([f.name]))
        text = iso(col) if isinstance(f.dataType, (TimestampType, TimestampNTZType)) else col.cast("string")
        pairs.append(F.struct(F.lit(f.name).alias("name"), text.alias("value")))
    return F.filter(F.array(*pairs), lambda p: p["value"].isNotNull())


def parse_json_field(df: DataFrame, col: str, renames: Mapping[str, str]) -> DataFrame:
    """JSON text of the form {key: [values]} to one list column per wanted key; a missing key gives null."""
    parsed = F.from_json(col, "map<string,array<string>>")
    return df.withColumn("_json", parsed).select(
        *df.columns, *[F.try_element_at("_json", F.lit(key)).alias(name) for key, name in renames.items()]
    )
