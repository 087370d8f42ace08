"""Warehouse tables: catalog tables on parquet, written by append or by a new location.

Rows are never written into the files a plan reads. A replaced table, or a rewritten
partition, is written to a new folder first; then the catalog is pointed at it. A job
lost in between leaves the old rows in place, and a rerun writes another folder.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable, Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from matchmill import schemas
from matchmill.functions import dates
from matchmill.operators import guards, merge, transforms
from matchmill.operators.extract import Join, extract
from matchmill.operators.joins import semi_join
from matchmill.session import cut_lineage, freed_shuffles

BUCKET = "key_bucket"
ROWS = "n_rows"
#: How tables are stored. Ids are digits and letters of few kinds, which the default codec leaves as wide as they are.
CODEC = "zstd"


def _counted(df: DataFrame) -> tuple[DataFrame, Observation]:
    """``df`` with its rows counted by whatever job writes it.

    A task run again after a loss may be counted twice: the number is for reports and
    for telling an empty result.
    """
    seen = Observation()
    return df.observe(seen, F.count(F.lit(1)).alias(ROWS)), seen


class Warehouse:
    """Tables ``schema.table`` kept under one root folder.

    ``root`` must be visible to all executors. ``prefix`` separates several warehouses in
    one catalog. ``buckets`` is the number of partitions of tables an update may rewrite in
    part; raise it with the table size.
    """

    def __init__(self, spark: SparkSession, root: str, prefix: str = "", buckets: int = 64):
        self.spark = spark
        self.root = root.rstrip("/")
        self.prefix = prefix
        self.buckets = buckets

    # ---- names ----

    def _split(self, table: str) -> tuple[str, str]:
        schema, _, name = table.rpartition(".")
        return guards.identifier(schema or "public"), guards.identifier(name)

    def name(self, table: str) -> str:
        schema, name = self._split(table)
        return f"{self.prefix}{schema}.{name}"

    def _new_location(self, table: str) -> str:
        schema, name = self._split(table)
        return f"{self.root}/{schema}/{name}/v-{uuid.uuid4().hex}"

    def exists(self, table: str) -> bool:
        return self.spark.catalog.tableExists(self.name(table))

    # ---- DDL ----

    def create_schema(self, schema: str) -> None:
        guards.identifier(schema)
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {self.prefix}{schema} LOCATION '{self.root}/{schema}'")

    def create_table(
        self,
        table: str,
        columns: Mapping[str, str],
        primary_key: Sequence[str] = (),
        defaults: Mapping[str, str] | None = None,
        bucket_key: str | None = None,
    ) -> dict[str, Any]:
        """Create the table when absent. A key is recorded in the table properties; see ``check_key``."""
        schema, name = self._split(table)
        self.create_schema(schema)
        missing = [k for k in [*primary_key, *([bucket_key] if bucket_key else [])] if k not in columns]
        if missing:
            raise ValueError(f"key columns not in the table: {missing}")
        parts = []
        for column, kind in columns.items():
            default = f" DEFAULT {defaults[column]}" if defaults and column in defaults else ""
            parts.append(f"`{guards.identifier(column)}` {kind}{default}")
        properties = {"primary_key": ",".join(primary_key)}
        partitioned = ""
        if bucket_key:
            parts.append(f"`{BUCKET}` INT")
            partitioned = f"PARTITIONED BY (`{BUCKET}`)"
            properties |= {"bucket_key": bucket_key, "buckets": str(self.buckets)}
        listed = ", ".join(f"'{k}' = '{v}'" for k, v in properties.items() if v)
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.name(table)} ({', '.join(parts)}) USING parquet OPTIONS (compression '{CODEC}') {partitioned} "
            f"LOCATION '{self._new_location(table)}'" + (f" TBLPROPERTIES ({listed})" if listed else "")
        )
        return {"table_name": name, "schema": schema, "columns": dict(columns)}

    def create_fixed(self, *tables: schemas.Table) -> None:
        """Create the layer schemas and the given fixed tables (all by default)."""
        for layer in schemas.LAYERS:
            self.create_schema(layer)
        for t in tables or schemas.FIXED_TABLES:
            self.create_table(t.name, t.columns, t.primary_key, t.defaults, t.bucket_key)

    def _properties(self, table: str) -> dict[str, str]:
        rows = self.spark.sql(f"SHOW TBLPROPERTIES {self.name(table)}").collect()
        return {r["key"]: r["value"] for r in rows}

    def _buckets_of(self, table: str) -> tuple[str | None, int]:
        found = self._properties(table)
        return found.get("bucket_key"), int(found.get("buckets", "0"))

    def check_key(self, table: str) -> None:
        key = self._properties(table).get("primary_key")
        if key:
            guards.require_unique(self.read(table), key.split(","), table)

    def _require_new_keys(self, rows: DataFrame, table: str) -> None:
        """Fail when ``rows`` repeat a primary key, or bring one that the table has.

        Of a table bucketed by a column of ``rows`` only the partitions they go to are read.
        """
        names = self._properties(table).get("primary_key", "")
        if not names or any(k not in rows.columns for k in names.split(",")):
            return
        key = names.split(",")
        guards.require_unique(rows, key, table)
        bucket, n = self._buckets_of(table)
        touched = self._touched(rows, bucket, n) if bucket in rows.columns else None
        stored = self._of_buckets(table, touched).select(*key)
        if stored.isEmpty():
            return
        # The rows' keys are known to be unique by now: no table of distinct ones is needed.
        present = stored.join(rows.select(*key), key, "left_semi")
        if not present.isEmpty():
            raise ValueError(f"{table} has rows with these keys already: {present.limit(3).collect()}")

    # ---- reading ----

    def read(self, table: str) -> DataFrame:
        """The table without its partition column."""
        return self._stored(table).drop(BUCKET)

    def _stored(self, table: str) -> DataFrame:
        return self.spark.table(self.name(table))

    def extract(
        self,
        table: str,
        select: Sequence[str] | None = None,
        joins: Sequence[Mapping[str, Any]] = (),
        where: Mapping[str, Any] | None = None,
        order: str | Sequence[str] | None = None,
        limit: int | None = None,
        skip_empty: bool = False,
    ) -> DataFrame:
        """``operators.extract`` by table name.

        A join is a mapping of ``table``, ``on``, and optionally ``alias`` and ``type``; a
        joined table without a schema is in the main table's. ``skip_empty`` ends the job
        as skipped when nothing is found.
        """
        schema, _ = self._split(table)
        listed = []
        for join in joins:
            name = join["table"] if "." in join["table"] else f"{schema}.{join['table']}"
            alias = join.get("alias") or name.rpartition(".")[2]
            listed.append(Join(self.read(name), join["on"], alias, join.get("type", "INNER")))
        found = extract(self.read(table), select, listed, where, order, limit)
        return guards.skip_if_empty(found, table) if skip_empty else found

    # ---- inserting ----

    def insert(
        self,
        df: DataFrame,
        table: str,
        mode: str = "append",
        job_id: str | None = None,
        job_time: dt.datetime | str | None = None,
        derive: Callable[[DataFrame], DataFrame] | None = None,
    ) -> dict[str, Any]:
        """Append to, replace, or (``fail``) only create a table; zero rows is an error.

        With ``job_id`` and ``job_time`` the two job columns are added. ``derive`` makes the table's columns, row by
        row, of a narrower ``df`` that has the bucket key already: rows are gathered by partition before it.
        """
        if mode not in ("append", "replace", "fail"):
            raise ValueError(f"insert mode {mode!r}")
        schema, name = self._split(table)
        if job_id is not None:
            made = derive or (lambda rows: rows)
            derive = lambda rows: transforms.tech_info(made(rows), job_id, job_time)
        self.create_schema(schema)
        present = self.exists(table)
        if present and mode == "fail":
            raise ValueError(f"table {table} exists")
        # Nothing is changed by zero rows, so they are noticed in the writing job itself.
        if present and mode == "append":
            key = self._buckets_of(table)[0]
            gathered = key in df.columns
            df = self._gathered(df, table, derive) if gathered else derive(df) if derive else df
            if self._properties(table).get("primary_key"):
                rows = self._append_new(df, table, gathered)
            else:
                rows = self._append(df, table, gathered)
        else:
            rows = self._new_version(derive(df) if derive else df, table, present)
        if rows == 0:
            raise guards.NoRows(f"no rows to insert into {table}")
        return {"table_name": name, "schema": schema, "rows_inserted": rows}

    def insert_lines(
        self, table: str, lines: Sequence[Mapping[str, Any]], types: Mapping[str, str] | None = None
    ) -> dict[str, Any] | None:
        """Insert literal rows by column name; nothing happens for an empty list.

        ``types`` declares the columns of a table that does not exist yet.
        """
        if not lines:
            return None
        schema, name = self._split(table)
        if not self.exists(table):
            if not types:
                raise ValueError(f"table {table} does not exist and no column types are given")
            self.create_table(table, types)
        known = {f.name: f.dataType for f in self._stored(table).schema}
        named = [c for c in known if any(c in line for line in lines)]
        unknown = {c for line in lines for c in line} - set(known)
        if unknown:
            raise KeyError(f"columns not in {table}: {sorted(unknown)}")
        wanted = T.StructType([T.StructField(c, known[c]) for c in named])
        df = self.spark.createDataFrame([tuple(line.get(c) for c in named) for line in lines], wanted)
        self._require_new_keys(df, table)
        self._append(df, table)
        return {"table_name": name, "schema": schema, "rows_inserted": len(lines)}

    def _gathered(self, df: DataFrame, table: str, derive: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
        """The rows, gathered by the partitions of the table that they go to and then widened."""
        key, n = self._buckets_of(table)
        df = _few_files(df.withColumn(BUCKET, _bucket(F.col(key), n))).drop(BUCKET)
        return derive(df) if derive else df

    def _whole_rows(self, df: DataFrame, table: str) -> DataFrame:
        """``df`` in the table's columns and types: defaults for absent columns, lengths checked, the partition told."""
        declared = self._stored(table).schema
        self._require_known(df, table)
        out = []
        for field in declared:
            if field.name == BUCKET:
                continue
            if field.name in df.columns:
                column = merge.assigned(F.col(f"`{field.name}`"), df.schema[field.name].dataType, field.dataType)
            else:
                column = F.expr(field.metadata.get("CURRENT_DEFAULT", "NULL")).cast(field.dataType)
            out.append(column.alias(field.name))
        key, n = self._buckets_of(table)
        return _within_lengths(df.select(*out), declared).withColumn(BUCKET, _bucket(F.col(key), n))

    def _require_known(self, df: DataFrame, table: str) -> None:
        stored = set(self._stored(table).columns)
        unknown = [c for c in df.columns if c not in stored]
        if unknown:
            raise KeyError(f"columns not in {table}: {unknown}")

    def _append_new(self, df: DataFrame, table: str, gathered: bool) -> int:
        """Append rows whose primary keys must be new.

        Rows of a partitioned table are written once, to a folder that becomes the place of the partitions the
        table has not yet; those of its other partitions are copied from there.
        """
        if self._buckets_of(table)[0] is None:
            df = cut_lineage(df, "insert")  # read by the key check and by the write
            self._require_new_keys(df, table)
            return self._append(df, table)
        name, location = self.name(table), self._new_location(table)
        rows = self._whole_rows(df, table)
        counted, seen = _counted(rows if gathered else _few_files(rows))
        with freed_shuffles(self.spark):
            counted.write.partitionBy(BUCKET).parquet(location, compression=CODEC)
        if seen.get[ROWS] == 0:
            return 0
        staged = self.spark.read.schema(rows.schema).parquet(location)
        self._require_new_keys(staged, table)
        present = {int(r[0].partition("=")[2]) for r in self.spark.sql(f"SHOW PARTITIONS {name}").collect()}
        brought = {int(r[0]) for r in staged.select(BUCKET).distinct().collect()}
        again = sorted(brought & present)
        if again:
            columns = ", ".join(f"`{c}`" for c in rows.columns)
            more = staged.where(F.col(BUCKET).isin(again))
            more.sparkSession.sql(f"INSERT INTO {name} ({columns}) SELECT {columns} FROM {{rows}}", rows=more)
        if brought - present:
            parts = [f"PARTITION ({BUCKET} = {b}) LOCATION '{location}/{BUCKET}={b}'" for b in sorted(brought - present)]
            self.spark.sql(f"ALTER TABLE {name} ADD {' '.join(parts)}")
        self.spark.catalog.refreshTable(name)
        return seen.get[ROWS]

    def _append(self, df: DataFrame, table: str, gathered: bool = False) -> int:
        """Append by column name; absent columns take their declared default."""
        self._require_known(df, table)
        stored = {f.name: f.dataType for f in self._stored(table).schema}
        df = df.select(
            *[merge.assigned(F.col(f"`{f.name}`"), f.dataType, stored[f.name]).alias(f.name) for f in df.schema]
        )
        key, n = self._buckets_of(table)
        if key:
            df = df.withColumn(BUCKET, _bucket(F.col(key), n))
            df = df if gathered else _few_files(df)
        counted, seen = _counted(df)
        columns = ", ".join(f"`{c}`" for c in df.columns)
        # The rows' own session: that of a stream's batch is not the one tables are read with.
        with freed_shuffles(counted.sparkSession):
            counted.sparkSession.sql(
                f"INSERT INTO {self.name(table)} ({columns}) SELECT {columns} FROM {{rows}}", rows=counted
            )
        self.spark.catalog.refreshTable(self.name(table))
        return seen.get[ROWS]

    def _new_version(self, df: DataFrame, table: str, present: bool) -> int:
        """Write ``df`` to a new folder and point the table at it; an empty result is not published."""
        location = self._new_location(table)
        counted, seen = _counted(df)
        with freed_shuffles(self.spark):
            counted.write.parquet(location, compression=CODEC)
        if seen.get[ROWS] == 0:
            return 0
        name = self.name(table)
        if present and _same_columns(self._stored(table).schema, df.schema):
            self.spark.sql(f"ALTER TABLE {name} SET LOCATION '{location}'")
        else:
            # Columns cannot be exchanged in one catalog change. The rows are safe in their folder by now;
            # a job lost between the two statements leaves no table, and its rerun, which replaces too, makes it.
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
            self.spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet OPTIONS (compression '{CODEC}') LOCATION '{location}'")
        self.spark.catalog.refreshTable(name)
        return seen.get[ROWS]

    def insert_ignore(self, df: DataFrame, table: str, keys: Sequence[str]) -> int:
        """Append the rows whose key the table does not have yet."""
        key, n = self._buckets_of(table)
        target = self._of_buckets(table, self._touched(df, key, n) if key in keys else None)
        return self._append(merge.insert_ignore(target.select(*keys), df, keys), table)

    # ---- upkeep ----

    def compact(self, table: str) -> int:
        """Write the table's rows anew, in few files; returns their number. Appends leave a file per task."""
        stored = self._stored(table)
        if self._buckets_of(table)[0] is None:
            stored = stored.hint("rebalance")
        return self._rewrite(table, stored.withColumn("_kept", F.lit(True)), "_kept", None)

    def remove_replaced(self, table: str) -> int:
        """Delete the folders that earlier versions of the table, or of its partitions, have left; returns how many.

        Call it when no query reads an earlier version any more.
        """
        schema, name = self._split(table)
        path_of = self.spark._jvm.org.apache.hadoop.fs.Path
        top = path_of(f"{self.root}/{schema}/{name}")
        system = top.getFileSystem(self.spark._jsc.hadoopConfiguration())
        described = self.spark.sql(f"DESCRIBE TABLE EXTENDED {self.name(table)}").where("col_name = 'Location'").first()
        used = {path_of(described["data_type"]).toUri().getPath()}
        used |= {path_of(f).getParent().toUri().getPath() for f in self._stored(table).inputFiles()}
        removed = 0
        for version in system.listStatus(top):
            folder = version.getPath().toUri().getPath()
            inside = [p.getPath() for p in system.listStatus(version.getPath()) if p.isDirectory()]
            if not any(u == folder or u.startswith(f"{folder}/") for u in used):
                removed += system.delete(version.getPath(), True)
                continue
            for part in inside:
                if part.getName().startswith(f"{BUCKET}=") and part.toUri().getPath() not in used:
                    removed += system.delete(part, True)
        return removed

    # ---- rewriting ----

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
        """MERGE ``source`` (a written table, read more than once) into ``table``.

        Inserts are appended: no target file is rewritten. When the table is bucketed by a
        merge key only the partitions holding a source key are read, by either branch, and
        rewritten by updates; else the whole table is.
        """
        names, mapping = list(match_columns), dict(non_match_columns or {})
        operations = merge.check_branches(names, mapping, has_matched, has_not_matched)
        moment: Column = dates.utc_timestamp(now or dt.datetime.now(dt.timezone.utc))
        key, n = self._buckets_of(table)
        touched = self._touched(source, key, n) if key in keys else None
        target = self._of_buckets(table, touched)
        new, empty = None, target.isEmpty()
        whole = empty
        if has_not_matched:
            new = source if empty else merge.unmatched_source(target.select(*keys), source, keys)
            whole = new is source
            new = new.select(
                *[F.col(f"`{s}`").alias(t) for t, s in mapping.items()],
                moment.alias(merge.CREATED),
                moment.alias(merge.MODIFIED),
            )
        if new is not None:
            # Both branches look at the target as it was, and the key check reads the new rows too: fix them,
            # unless they are the source, which is written and of which the target has no key.
            new = new if whole else cut_lineage(new, "merge-new")
            primary = [k for k in self._properties(table).get("primary_key", "").split(",") if k]
            if primary and all(k in new.columns for k in primary):
                guards.require_unique(new.dropna(subset=primary), primary, table)
        rows = 0
        if has_matched:
            self._keep_bucket_key(table, [c for c in names if c not in keys])
            if not empty:
                changed = merge.matched_rows(target, source, keys, names, moment, written=True)
                rows += self._rewrite(table, changed, "_matched", touched)
        if new is not None:
            rows += self._append(new, table)
        schema, name = self._split(table)
        return {"target_table": f"{schema}.{name}", "operations_performed": operations, "rows_affected": rows}

    def update(
        self, table: str, set_values: Mapping[str, Any], where: Mapping[str, Any]
    ) -> dict[str, Any]:
        """``UPDATE … SET … WHERE …``; see ``merge.update_where``.

        Only partitions with a row to change are rewritten. They are known from the bucket
        key if ``where`` names it; else the condition's columns are read to find them.
        """
        schema, name = self._split(table)
        self._keep_bucket_key(table, set_values)
        key, n = self._buckets_of(table)
        touched = None
        if key in where and not isinstance(where[key], DataFrame):
            literal = self.spark.range(1).select(F.lit(where[key]).cast(self._stored(table).schema[key].dataType).alias(key))
            touched = self._touched(literal, key, n)
        changed = merge.update_where(self._of_buckets(table, touched), set_values, where)
        if key and touched is None:
            touched = self._changed_buckets(changed)
            changed = changed.where(F.col(BUCKET).isin(touched))
        return {"table_name": name, "schema": schema, "rows_updated": self._rewrite(table, changed, "_updated", touched)}

    def update_in(
        self, table: str, set_values: Mapping[str, Any], key: str, members: DataFrame
    ) -> dict[str, Any]:
        """``UPDATE … WHERE key IN (SELECT key FROM members)``."""
        schema, name = self._split(table)
        self._keep_bucket_key(table, set_values)
        bucket_key, n = self._buckets_of(table)
        touched = self._touched(members, key, n) if bucket_key == key else None
        changed = merge.update_where_in(self._of_buckets(table, touched), set_values, key, members)
        if bucket_key and touched is None:
            touched = self._changed_buckets(changed)
            changed = changed.where(F.col(BUCKET).isin(touched))
        return {"table_name": name, "schema": schema, "rows_updated": self._rewrite(table, changed, "_updated", touched)}

    def _keep_bucket_key(self, table: str, columns: Mapping[str, Any] | Sequence[str]) -> None:
        key, _ = self._buckets_of(table)
        if key in columns:
            raise ValueError(f"{table} is partitioned by {key}: it cannot be updated")

    def _touched(self, source: DataFrame, key: str, n: int) -> list[int]:
        """The partitions holding source keys: at most ``n`` small numbers."""
        found = source.where(F.col(key).isNotNull()).select(_bucket(F.col(key), n).alias(BUCKET)).distinct()
        return sorted(r[0] for r in found.collect())

    def _of_buckets(self, table: str, touched: list[int] | None) -> DataFrame:
        """The stored table, or those of its partitions only."""
        stored = self._stored(table)
        return stored if touched is None else stored.where(F.col(BUCKET).isin(touched))

    def _changed_buckets(self, changed: DataFrame) -> list[int]:
        return sorted(r[0] for r in changed.where("_updated").select(BUCKET).distinct().collect())

    def _rewrite(self, table: str, changed: DataFrame, flag: str, touched: list[int] | None) -> int:
        """Publish ``changed`` (target rows plus a flag column) and return the number of flagged rows."""
        if touched == []:
            return 0
        name, location = self.name(table), self._new_location(table)
        changed = _within_lengths(changed, self._stored(table).schema)
        seen = Observation()
        counted = changed.observe(seen, F.count_if(F.col(flag)).alias(ROWS)).drop(flag)
        partitioned = self._buckets_of(table)[0] is not None
        if not partitioned:
            with freed_shuffles(self.spark):
                counted.write.parquet(location, compression=CODEC)
            self.spark.sql(f"ALTER TABLE {name} SET LOCATION '{location}'")
        else:
            with freed_shuffles(self.spark):
                _few_files(counted).write.partitionBy(BUCKET).parquet(location, compression=CODEC)
            present = {int(r[0].partition("=")[2]) for r in self.spark.sql(f"SHOW PARTITIONS {name}").collect()}
            for bucket in sorted(present if touched is None else present.intersection(touched)):
                part = f"{name} PARTITION ({BUCKET} = {bucket})"
                self.spark.sql(f"ALTER TABLE {part} SET LOCATION '{location}/{BUCKET}={bucket}'")
        self.spark.catalog.refreshTable(name)
        return seen.get[ROWS]


def _bucket(key: Column, n: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(n)).cast("int")


def _within_lengths(df: DataFrame, stored: T.StructType) -> DataFrame:
    """Fail the query on a text longer than its column declares, as an INSERT does."""
    checked = {}
    for field in stored:
        declared = field.metadata.get("__CHAR_VARCHAR_TYPE_STRING", "")
        if declared.startswith("varchar("):
            most = int(declared[8:-1])
            column = F.col(f"`{field.name}`")
            too_long = F.raise_error(F.lit(f"EXCEED_LIMIT_LENGTH: {field.name} takes {most} characters")).cast("string")
            checked[field.name] = F.when(F.char_length(column) > most, too_long).otherwise(column)
    return df.withColumns(checked) if checked else df


def _few_files(df: DataFrame) -> DataFrame:
    """Rows gathered by partition, so that not every task writes to every partition.

    Unlike a repartition, AQE spreads the rows of a large partition over several tasks.
    """
    return df.hint("rebalance", F.col(BUCKET))


def _same_columns(a: T.StructType, b: T.StructType) -> bool:
    return [(f.name, f.dataType) for f in a] == [(f.name, f.dataType) for f in b]
