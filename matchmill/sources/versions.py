"""Warehouse tables that change by one catalog statement, whatever the change is.

A table is a view over generations: plain tables whose files are never changed once they are
written. A change writes one more generation, out of sight, and then replaces the view, which names
the generations and, of each, the partitions that still count. So a reader sees the rows before a
change or those after it: never some partitions of either, and never no table. A job lost before
that statement has changed nothing; what it has written is found and removed by ``remove_replaced``.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from matchmill.functions import dates
from matchmill.operators import guards, merge
from matchmill.session import cut_lineage, freed_shuffles
from matchmill.sources.warehouse import BUCKET, CODEC, ROWS, Warehouse, _bucket, _counted, _few_files, _same_columns, _within_lengths

_SETTINGS = ("primary_key", "bucket_key", "buckets", "defaults")


@dataclass(frozen=True)
class Generation:
    """A table of the same columns; of its partitions ``live`` count, or all where it has none."""

    table: str
    live: tuple[int, ...] | None = None
    whole: bool = True

    def text(self) -> str:
        """As a property: a short text, with a bit for each partition."""
        bits = "" if self.live is None else f"{sum(1 << b for b in self.live):x}"
        return f"{self.table}:{bits}:{int(self.whole)}"

    @staticmethod
    def of(text: str) -> Generation:
        table, bits, whole = text.split(":")
        number = int(bits, 16) if bits else 0
        live = tuple(b for b in range(number.bit_length()) if number >> b & 1) if bits else None
        return Generation(table, live, whole == "1")

    def without(self, gone: Sequence[int]) -> Generation:
        left = tuple(b for b in self.live or () if b not in set(gone))
        return Generation(self.table, left, self.whole and len(left) == len(self.live or ()))


class VersionedWarehouse(Warehouse):
    """A ``Warehouse`` whose inserts, replacements, updates and merges are each seen at once or not at all.

    A table of more than ``generations`` generations is written into one again. Tables are written
    by one job at a time; readers need not care.
    """

    def __init__(self, *args: Any, generations: int = 8, **kwargs: Any):
        super().__init__(*args, **kwargs)
        self.generations = generations

    def _sql(self, statement: str) -> DataFrame:
        return self.spark.sql(statement)

    # ---- the view ----

    def _listed(self, table: str) -> list[Generation]:
        found = {k: v for k, v in self._properties(table).items() if k.startswith("generation.")}
        return [Generation.of(found[k]) for k in sorted(found, key=lambda k: int(k.partition(".")[2]))]

    def _publish(self, table: str, generations: Sequence[Generation], settings: Mapping[str, str]) -> None:
        """The one statement that readers notice."""
        kept = [g for g in generations if g.live is None or g.live] or list(generations[-1:])
        columns = ", ".join(f"`{c}`" for c in self.spark.table(self.name(kept[-1].table)).columns)
        parts = []
        for generation in kept:
            some = "" if generation.whole else f" WHERE `{BUCKET}` IN ({', '.join(map(str, generation.live or ()))})"
            parts.append(f"SELECT {columns} FROM {self.name(generation.table)}{some}")
        properties = {k: v for k, v in settings.items() if k in _SETTINGS and v}
        properties |= {f"generation.{i}": g.text() for i, g in enumerate(kept)}
        quoted = ", ".join("'{}' = '{}'".format(k, v.replace("\\", "\\\\").replace("'", "\\'")) for k, v in properties.items())
        self._sql(f"CREATE OR REPLACE VIEW {self.name(table)} TBLPROPERTIES ({quoted}) AS {' UNION ALL '.join(parts)}")

    def _declared(self, table: str) -> T.StructType:
        """The stored columns with their declared lengths, which a view does not tell."""
        return self.spark.table(self.name(self._listed(table)[-1].table)).schema

    def _generation(self, table: str, rows: DataFrame, schema: T.StructType, gathered: bool = False) -> Generation | None:
        """Write ``rows`` as a new generation, or nothing if there are none; readers do not see it yet."""
        partitioned = BUCKET in rows.columns
        made, location = f"{table}__{uuid.uuid4().hex[:12]}", self._new_location(table)
        counted, seen = _counted(_few_files(rows) if partitioned and not gathered else rows)
        writer = counted.write.partitionBy(BUCKET) if partitioned else counted.write
        with freed_shuffles(self.spark):
            writer.parquet(location, compression=CODEC)
        if seen.get[ROWS] == 0:
            return None
        columns = ", ".join(f"`{f.name}` {f.metadata.get('__CHAR_VARCHAR_TYPE_STRING', f.dataType.simpleString())}" for f in schema)
        by = f"PARTITIONED BY (`{BUCKET}`)" if partitioned else ""
        self._sql(f"CREATE TABLE {self.name(made)} ({columns}) USING parquet {by} LOCATION '{location}'")
        if not partitioned:
            return Generation(made)
        self._sql(f"ALTER TABLE {self.name(made)} RECOVER PARTITIONS")
        present = self._sql(f"SHOW PARTITIONS {self.name(made)}").collect()
        return Generation(made, tuple(sorted(int(r[0].partition("=")[2]) for r in present)))

    # ---- what Warehouse builds on ----

    def create_table(
        self,
        table: str,
        columns: Mapping[str, str],
        primary_key: Sequence[str] = (),
        defaults: Mapping[str, str] | None = None,
        bucket_key: str | None = None,
    ) -> dict[str, Any]:
        schema, name = self._split(table)
        self.create_schema(schema)
        if not self.exists(table):
            made = f"{table}__{uuid.uuid4().hex[:12]}"
            super().create_table(made, columns, primary_key, defaults, bucket_key)
            settings = {**super()._properties(made), "defaults": json.dumps(dict(defaults or {}))}
            self._publish(table, [Generation(made, () if bucket_key else None)], settings)
        return {"table_name": name, "schema": schema, "columns": dict(columns)}

    def partitions_of(self, table: str, keys: DataFrame) -> DataFrame:
        """All rows of the partitions that ``keys``, a written table of the bucket key, go to."""
        key, n = self._buckets_of(table)
        return self._of_buckets(table, self._touched(keys, key, n) if key else None).drop(BUCKET)

    def rows_of(self, table: str, keys: DataFrame) -> DataFrame:
        """The rows whose bucket key is among ``keys``, a written table of that column: of their partitions only."""
        key, _ = self._buckets_of(table)
        return self.partitions_of(table, keys).join(keys, [key] if key else keys.columns, "left_semi")

    def _whole_rows(self, df: DataFrame, table: str) -> DataFrame:
        """``df`` in the table's columns and types: defaults for absent columns, lengths checked, the partition told."""
        declared = self._declared(table)
        stored = {f.name: f.dataType for f in declared if f.name != BUCKET}
        unknown = [c for c in df.columns if c not in stored]
        if unknown:
            raise KeyError(f"columns not in {table}: {unknown}")
        settings = self._properties(table)
        defaults = json.loads(settings.get("defaults", "{}"))
        out = []
        for name, kind in stored.items():
            if name in df.columns:
                column = merge.assigned(F.col(f"`{name}`"), df.schema[name].dataType, kind)
            else:
                column = F.expr(defaults.get(name, "NULL")).cast(kind)
            out.append(column.alias(name))
        rows = _within_lengths(df.select(*out), T.StructType([f for f in declared if f.name != BUCKET]))
        key = settings.get("bucket_key")
        return rows.withColumn(BUCKET, _bucket(F.col(key), int(settings["buckets"]))) if key else rows

    def _change(self, table: str, rows: DataFrame, gone: Sequence[int] | None = (), gathered: bool = False) -> None:
        """Publish ``rows``, which may be gathered by partition already, in the place of the partitions ``gone`` (of everything, if None)."""
        settings = self._properties(table)
        made = self._generation(table, rows, self._declared(table), gathered)
        old = [] if gone is None else [g.without(gone) if gone else g for g in self._listed(table)]
        if made is None and gone is None:
            # Nothing is left: an empty generation takes the old ones' place.
            empty = f"{table}__{uuid.uuid4().hex[:12]}"
            self._sql(f"CREATE TABLE {self.name(empty)} LIKE {self.name(self._listed(table)[-1].table)} LOCATION '{self._new_location(table)}'")
            made = Generation(empty, () if settings.get("bucket_key") else None)
        listed = [*old, *([made] if made else [])]
        self._publish(table, listed, settings)
        if len(listed) > self.generations:
            self.compact(table)

    def _append_new(self, df: DataFrame, table: str, gathered: bool) -> int:
        return self._append(df, table, gathered, new_keys=True)

    def _append(self, df: DataFrame, table: str, gathered: bool = False, new_keys: bool = False) -> int:
        counted, seen = _counted(self._whole_rows(df, table))
        made = self._generation(table, counted, self._declared(table), gathered)
        if made and new_keys:  # of what is written, before anyone sees it
            self._require_new_keys(self.spark.table(self.name(made.table)), table)
        if made:
            listed = [*self._listed(table), made]
            self._publish(table, listed, self._properties(table))
            if len(listed) > self.generations:
                self.compact(table)
        return seen.get[ROWS]

    def _new_version(self, df: DataFrame, table: str, present: bool) -> int:
        """Other rows, and maybe other columns, in the table's place."""
        same = present and _same_columns([f for f in self._stored(table).schema if f.name != BUCKET], df.schema)
        if same:
            rows, schema, settings = self._whole_rows(df, table), self._declared(table), self._properties(table)
        else:
            rows, schema, settings = df, df.schema, {}
        counted, seen = _counted(rows)
        made = self._generation(table, counted, schema)
        if made:
            self._publish(table, [made], settings)
        return seen.get[ROWS]

    def _rewrite(self, table: str, changed: DataFrame, flag: str, touched: list[int] | None) -> int:
        if touched == []:
            return 0
        seen = Observation()
        counted = _within_lengths(changed, self._declared(table)).observe(seen, F.count_if(F.col(flag)).alias(ROWS)).drop(flag)
        self._change(table, counted, touched)
        return seen.get[ROWS]

    def merge(
        self,
        source: DataFrame,
        table: str,
        keys: Sequence[str],
        match_columns: Sequence[str] | Mapping[str, str] = (),
        non_match_columns: Mapping[str, str] | None = None,
        has_matched: bool = False,
        has_not_matched: bool = False,
        now: dt.datetime | str | None = None,
    ) -> dict[str, Any]:
        """``Warehouse.merge`` whose updates and inserts are published together."""
        if not (has_matched and has_not_matched):
            return super().merge(source, table, keys, match_columns, non_match_columns, has_matched, has_not_matched, now)
        names, mapping = list(match_columns), dict(non_match_columns or {})
        operations = merge.check_branches(names, mapping, has_matched, has_not_matched)
        moment: Column = dates.utc_timestamp(now or dt.datetime.now(dt.timezone.utc))
        self._keep_bucket_key(table, [c for c in names if c not in keys])
        key, n = self._buckets_of(table)
        touched = self._touched(source, key, n) if key in keys else None
        target = self._of_buckets(table, touched)
        empty = target.isEmpty()
        new = source if empty else merge.unmatched_source(target.select(*keys), source, keys)
        whole = new is source
        new = new.select(
            *[F.col(f"`{s}`").alias(t) for t, s in mapping.items()], moment.alias(merge.CREATED), moment.alias(merge.MODIFIED)
        )
        new = new.select([c for c in new.columns if c in target.columns])
        new = new if whole else cut_lineage(new, "merge-new")  # the source is written
        primary = [k for k in self._properties(table).get("primary_key", "").split(",") if k]
        if primary and all(k in new.columns for k in primary):
            guards.require_unique(new.dropna(subset=primary), primary, table)
        changed = self._whole_rows(new, table).withColumn("_matched", F.lit(True))
        if not empty:
            changed = merge.matched_rows(target, source, keys, names, moment, written=True).unionByName(changed)
        schema, name = self._split(table)
        return {
            "target_table": f"{schema}.{name}",
            "operations_performed": operations,
            "rows_affected": self._rewrite(table, changed, "_matched", touched),
        }

    # ---- upkeep ----

    def compact(self, table: str) -> int:
        """Write the table's rows into one generation of few files; returns their number."""
        stored = self._stored(table)
        if BUCKET not in stored.columns:
            stored = stored.hint("rebalance")
        return self._rewrite(table, stored.withColumn("_kept", F.lit(True)), "_kept", None)

    def remove_replaced(self, table: str) -> int:
        """Drop generations that the table does not name, with their folders; returns how many folders went.

        Call it when no query reads an earlier version and no job is writing one.
        """
        schema, name = self._split(table)
        path_of = self.spark._jvm.org.apache.hadoop.fs.Path
        used = set()
        listed = {g.table.rpartition(".")[2] for g in self._listed(table)}
        for found in self._sql(f"SHOW TABLES IN {self.prefix}{schema} LIKE '{name}__*'").collect():
            made = f"{schema}.{found['tableName']}"
            if found["tableName"] in listed:
                described = self._sql(f"DESCRIBE TABLE EXTENDED {self.name(made)}").where("col_name = 'Location'").first()
                used.add(path_of(described["data_type"]).toUri().getPath())
            elif found["tableName"].startswith(f"{name}__"):
                self._sql(f"DROP TABLE IF EXISTS {self.name(made)}")
        removed = 0
        for folder in self._folders(schema, name):
            if folder.toUri().getPath() not in used:
                removed += folder.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(folder, True)
        return removed

    def _folders(self, schema: str, name: str) -> list:
        """The folders of all versions of a table, its first empty one's included."""
        top = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{schema}")
        system = top.getFileSystem(self.spark._jsc.hadoopConfiguration())
        found = []
        for table in system.listStatus(top):
            if table.getPath().getName() == name or table.getPath().getName().startswith(f"{name}__"):
                found += [version.getPath() for version in system.listStatus(table.getPath())]
        return found
