"""Packing a corpus that arrives as a stream of files.

Each micro-batch adds its documents to the open shard, as a segment of its own that later
batches refer to and do not write again; what a batch writes does not depend on how full the
shard is. When it is full, shards are published and the rest is the first segment of the next.
The state is named by the batch id: a batch replayed after a failure finds its state, or its
files, already there.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shardloom.functions.naming import ThreeWay, TwoWay, with_layout
from shardloom.functions.vocab import ByteVocab, Packed, RankVocab
from shardloom.operators.offsets import token_offsets
from shardloom.operators.packing import SHARD_SIZE, shard_manifest, shard_tokens
from shardloom.plans.build import GROW, adopt, all_published, publish, read_manifest, recover
from shardloom.session import attach, written
from shardloom.sources.corpus import SOURCE_ORDER, positioned
from shardloom.sources.paths import exists, resolve

STATE = "state"

# Left-over rows go before a batch's own, whose positions start at 0.
CARRY_BASE = -(1 << 40)


MARK = (
    "next_shard bigint, docs_seen bigint, fill bigint, open_rows bigint, segments array<bigint>, settings string"
)


@dataclass(frozen=True)
class _State:
    """Shards and documents so far, and the open shard: tokens, rows and the segments that hold them."""

    next_shard: int = 0
    docs_seen: int = 0
    fill: int = 0
    open_rows: int = 0
    segments: tuple[int, ...] = ()


@dataclass
class StreamPacker:
    """A ``foreachBatch`` function; call :meth:`finalize` once the corpus is complete.

    Inside a batch ``order_by`` orders the documents (see ``positioned``); batches follow
    each other as they arrive.
    """

    spark: SparkSession
    dst: str
    vocab: ByteVocab | RankVocab | None = None
    id_col: str = "id"
    text_col: str = "text"
    order_by: str | Sequence[str] = SOURCE_ORDER
    eot: bool = True
    shard_size: int = SHARD_SIZE
    layout: ThreeWay | TwoWay = ThreeWay()

    def __post_init__(self) -> None:
        attach(self.spark)
        self.vocab = self.vocab or ByteVocab()
        self.dst = self.dst.rstrip("/")
        self.codec = self.vocab.codec(self.eot)
        self.packed = Packed(self.codec.width)

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        recover(self.spark, self.dst, self.shard_size)
        if batch_id not in self._saved():
            self._pack(batch, batch_id)

    def finalize(self) -> DataFrame:
        """Publish the partial shard, if any tokens are left; returns the manifest.

        More batches may follow: the open shard's rows are still state, and its full version
        takes the place of the partial one.
        """
        recover(self.spark, self.dst, self.shard_size)
        if self._saved():
            self._pack(None, max(self._saved()) + 1)
        return read_manifest(self.spark, self.dst)

    def _pack(self, batch: DataFrame | None, batch_id: int) -> None:
        state = self._state(batch_id)
        if batch is None:
            self._close(None, batch_id, state)
            return
        arrived = self._arrivals(batch, self._folder(batch_id))
        offsets = token_offsets(arrived.select("pos", "id", "n"))
        docs, tokens = offsets.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
        if state.fill + tokens < self.shard_size:
            self._append(arrived, offsets, batch_id, state, docs, tokens)
        else:
            self._close(arrived, batch_id, state)

    def _append(
        self, arrived: DataFrame, offsets: DataFrame, batch_id: int, state: _State, docs: int, tokens: int
    ) -> None:
        """The open shard stays open: this batch's rows are one more segment of it."""
        place = F.col("ordinal")
        rows = arrived.drop("doc_no").join(offsets.select("pos", "ordinal"), "pos").select(
            (place + F.lit(CARRY_BASE + state.open_rows)).alias("pos"), "id", "n", "body",
            (place + F.lit(state.docs_seen)).alias("doc_no"),
        )
        rows.write.mode("overwrite").parquet(self._segment(batch_id))
        self._save(batch_id, _State(
            state.next_shard, state.docs_seen + docs, state.fill + tokens, state.open_rows + docs,
            (*state.segments, batch_id),
        ))

    def _close(self, arrived: DataFrame | None, batch_id: int, state: _State) -> None:
        """Publish what is full, or all at the end; what is left is the new open shard."""
        last = arrived is None
        folder = self._folder(batch_id)
        tokens = self._open_rows(state)
        if not last:
            tokens = arrived if tokens is None else tokens.unionByName(arrived)
        if tokens is None:
            return
        offsets = written(token_offsets(tokens.drop("body")), "offsets", f"{folder}/offsets")
        carried, total = offsets.agg(F.count("doc_no"), F.count("*")).first()
        # Documents keep the number they got on arrival, left-over ones included.
        number = F.coalesce("doc_no", F.col("ordinal") + F.lit(state.docs_seen - carried))
        offsets = offsets.withColumn("ordinal", number)
        manifest = shard_manifest(offsets, self.shard_size, self.layout)
        shifted = manifest.withColumn("shard_id", F.col("shard_id") + state.next_shard)
        shards = written(with_layout(shifted, self.layout), "shards", f"{folder}/shards")

        done = F.lit(True) if last else F.col("n_tokens") == self.shard_size
        n_done = shards.filter(done).count()
        if n_done:
            report = self._publish(tokens, shards.filter(done))
            all_published(report)  # else the state stays, and the batch is tried again
            if not report.filter(F.col("status") == "skipped").isEmpty():  # a replay
                adopt(shards.filter(done), self.dst, self.shard_size)
                self._recorded(shards.filter(done))
        if last:
            return
        rest = shard_tokens(tokens, shards.filter(~done), self.packed, ("id",))
        numbers = offsets.select("pos", F.col("ordinal").alias("doc_no"))
        place = F.row_number().over(Window.partitionBy("shard_id").orderBy("pos")) - 1
        segment = rest.join(numbers, "pos").select(
            (place + F.lit(CARRY_BASE)).alias("pos"),
            "id",
            F.expr(f"cast(octet_length(payload) div {self.packed.width} as bigint)").alias("n"),
            F.col("payload").alias("body"),
            "doc_no",
        )
        left = written(segment, "segment", self._segment(batch_id))
        rows, fill = left.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
        self._save(batch_id, _State(
            state.next_shard + n_done, state.docs_seen + total - carried, fill, rows, (batch_id,)
        ))

    def _publish(self, tokens: DataFrame, shards: DataFrame) -> DataFrame:
        return publish(tokens, shards, self.packed, self.dst, self.shard_size, self.layout, GROW)

    def _recorded(self, shards: DataFrame) -> None:
        lost = shards.join(read_manifest(self.spark, self.dst), ["file_name", "n_tokens"], "left_anti")
        if not lost.isEmpty():
            raise RuntimeError("a shard that is in place is not in the manifest, nor is its length as planned")

    def _arrivals(self, batch: DataFrame, folder: str) -> DataFrame:
        keep = [F.col(self.id_col).alias("id"), F.col(self.text_col).alias("text")]
        placed = positioned(batch, self.order_by, keep, f"{folder}/arrivals")
        tokens = self.vocab.tokenized(placed, self.eot)
        zero = F.lit(0).cast("bigint")
        body = self.codec.payload(self.codec.cut(F.col("body"), zero, F.col("n")), zero)
        below = F.raise_error(F.lit("a stream's positions must not be negative"))
        packed = tokens.select(
            F.when(F.col("pos") < 0, below).otherwise(F.col("pos")).alias("pos"),
            "id",
            "n",
            body.alias("body"),
            F.lit(None).cast("bigint").alias("doc_no"),
        )
        # An encoder's output is kept rather than computed again in every pass.
        return written(packed, "tokens", f"{folder}/tokens") if self.vocab.staged else packed

    def _save(self, batch_id: int, state: _State) -> None:
        """Write the mark that makes this state count; drop what no kept state refers to."""
        row = (state.next_shard, state.docs_seen, state.fill, state.open_rows, list(state.segments), self._settings())
        mark = self.spark.createDataFrame([row], MARK)
        mark.write.mode("overwrite").parquet(f"{self._folder(batch_id)}/mark")
        older = sorted(saved for saved in self._saved() if saved < batch_id)
        kept = set(state.segments)
        if older:
            kept |= set(self._mark(older[-1]).segments)
        for old in older[:-1]:
            for segment in set(self._mark(old).segments) - kept:
                self._forget(self._segment(segment))
            self._forget(self._folder(old))

    def _settings(self) -> str:
        """What shapes the shards; a run that goes on from a state must agree in it."""
        return repr((
            self.vocab.fingerprint, self.eot, self.shard_size, self.layout, self.id_col,
            self.text_col, self.order_by,
        ))

    def _state(self, batch_id: int) -> _State:
        before = [saved for saved in self._saved() if saved < batch_id]
        return self._mark(max(before)) if before else _State()

    def _mark(self, batch_id: int) -> _State:
        mark = self.spark.read.schema(MARK).parquet(f"{self._folder(batch_id)}/mark").first()
        if mark.settings != self._settings():
            raise ValueError(f"the state was made with other settings: {mark.settings}")
        return _State(mark.next_shard, mark.docs_seen, mark.fill, mark.open_rows, tuple(mark.segments))

    def _open_rows(self, state: _State) -> DataFrame | None:
        """The open shard's rows: the segments that its batches wrote, by reference."""
        if not state.segments:
            return None
        return self.spark.read.parquet(*[self._segment(batch_id) for batch_id in state.segments])

    def _saved(self) -> list[int]:
        """Ids of the batches whose state is complete."""
        if not exists(f"{self.dst}/{STATE}"):
            return []
        fs, path = resolve(f"{self.dst}/{STATE}")
        names = [info.base_name for info in fs.get_file_info(pafs.FileSelector(path))]
        ids = [int(name.split("=")[1]) for name in names if name.startswith("batch=")]
        return [i for i in ids if exists(f"{self._folder(i)}/mark/_SUCCESS")]

    def _folder(self, batch_id: int) -> str:
        return f"{self.dst}/{STATE}/batch={batch_id}"

    def _segment(self, batch_id: int) -> str:
        return f"{self.dst}/{STATE}/segments/{batch_id}"

    def _forget(self, folder: str) -> None:
        if exists(folder):
            fs, path = resolve(folder)
            fs.delete_dir(path)


def pack_stream(
    stream: DataFrame, packer: StreamPacker, checkpoint_location: str
) -> DataFrame:
    """Run ``stream`` through ``packer`` until all files present are packed, then finalize."""
    query = (
        stream.writeStream.foreachBatch(packer)
        .option("checkpointLocation", checkpoint_location)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return packer.finalize()
