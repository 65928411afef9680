"""Keyword indexes: postings as a table with TF-IDF search and exact lookup, or a search server's index."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from typing import Any, Protocol

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomline.functions import text as X


class Searchable(Protocol):
    """What every index can do. search: doc_id, score, text of the best; exact: doc_id of the documents of this text."""

    def size(self) -> int: ...

    def search(self, query: str, top_k: int = 10) -> DataFrame: ...

    def exact(self, text: str) -> DataFrame: ...


@dataclass(frozen=True)
class Index:
    """postings(term, doc_id, tf) and docs(doc_id, text, key)."""

    postings: DataFrame
    docs: DataFrame

    def size(self) -> int:
        return self.docs.count()

    def idf(self) -> DataFrame:
        """term, idf = ln((N + 1) / (df + 1)) + 1."""
        n = self.size()
        return self.postings.groupBy("term").agg((F.log((F.lit(n) + 1) / (F.count("*") + 1)) + 1).alias("idf"))

    def search(self, query: str, top_k: int = 10) -> DataFrame:
        """doc_id, score (4 places), text of the best documents; equal scores in the order of ids.

        Only postings of the query's terms are read, with the filter pushed to the table; their frequencies come from
        the same rows.
        """
        spark = self.docs.sparkSession
        terms = spark.createDataFrame([(query,)], "q string").select(F.explode(X.words(F.lower("q"))).alias("term")).groupBy("term").agg(F.count("*").alias("times"))
        found = [r["term"] for r in terms.collect()]  # the query's own terms
        hits = self.postings.filter(F.col("term").isin(found)) if found else self.postings.limit(0)
        weights = hits.groupBy("term").agg((F.log((F.lit(self.size()) + 1) / (F.count("*") + 1)) + 1).alias("idf")).join(F.broadcast(terms), "term")
        scores = hits.join(F.broadcast(weights), "term").groupBy("doc_id").agg(F.sum(F.col("tf") * F.col("idf") * F.col("times")).alias("score"))
        best = scores.withColumn("score", F.round("score", 4)).orderBy(F.desc("score"), "doc_id").limit(top_k)
        return F.broadcast(best).join(self.docs.select("doc_id", "text"), "doc_id").orderBy(F.desc("score"), "doc_id")

    def exact(self, text: str) -> DataFrame:
        """doc_id of the documents of this text, but for case and outer white space."""
        key = X.lookup_key(F.lit(text))
        return self.docs.filter(F.col("key") == key).select("doc_id").orderBy("doc_id")


def _client(hosts: list[str]) -> Any:
    from elasticsearch import Elasticsearch

    return Elasticsearch(hosts)


@dataclass(frozen=True)
class ServerIndex:
    """An index on a search server. connect makes a client of it: with index(), search(), count() and indices."""

    spark: SparkSession
    index: str = "corpus"
    hosts: tuple[str, ...] = ("http://localhost:9200",)
    connect: Callable[[list[str]], Any] = _client
    #: The most hits that a lookup of a text reads.
    exact_hits: int = 50

    def add(self, docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> ServerIndex:
        """Executors send their own rows; other columns go along as fields. A retried task sends the same ids again."""
        hosts, index, connect = list(self.hosts), self.index, self.connect
        server = connect(hosts)
        if not server.indices.exists(index=index):
            server.indices.create(index=index)

        def send(rows) -> None:
            client = connect(hosts)
            for r in rows:
                fields = r.asDict(recursive=True)
                key = str(fields.pop(id_col))
                client.index(index=index, id=key, document={"text": fields.pop(text), **fields})

        docs.foreachPartition(send)
        return self

    def _hits(self, query: dict, size: int) -> DataFrame:
        found = self.connect(list(self.hosts)).search(index=self.index, query=query, size=size)["hits"]["hits"]
        return self.spark.createDataFrame([(h["_id"], float(h["_score"]), (h.get("_source") or {}).get("text")) for h in found], "doc_id string, score double, text string")

    def size(self) -> int:
        return self.connect(list(self.hosts)).count(index=self.index)["count"]

    def search(self, query: str, top_k: int = 10) -> DataFrame:
        return self._hits({"match": {"text": query}}, top_k)

    def exact(self, text: str) -> DataFrame:
        return self._hits({"match_phrase": {"text": text}}, self.exact_hits).select("doc_id")


def open_index(docs: DataFrame, id_col: str = "doc_id", text: str = "text", server: ServerIndex | None = None) -> Searchable:
    """The server's index with docs added, or one of tables where there is no server."""
    return build_index(docs, id_col, text) if server is None else server.add(docs, id_col, text)


def build_index(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> Index:
    """Of repeated ids the last text in order of text stays, so no stale terms remain."""
    latest = docs.groupBy(F.col(id_col).alias("doc_id")).agg(F.max(F.coalesce(F.col(text), F.lit(""))).alias("text"))
    postings = latest.select("doc_id", F.explode(X.words(F.lower("text"))).alias("term")).groupBy("term", "doc_id").agg(F.count("*").alias("tf"))
    return Index(postings, latest.withColumn("key", X.lookup_key(F.col("text"))))
