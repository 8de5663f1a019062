"""A search index over clients: postings of three-character pieces, the rarest looked up first.

Names, phones, tax ids and sale numbers are cut into tokens: pieces of three characters
where a part may be asked for, the whole where it may not. Postings name the groups (all
rows of a client, or a row without a tax id by itself) that hold a token and lie in folders
by the hash of the token, sorted, beside their counts. A search reads the counts of its
tokens, meets the postings of the few rarest, opens the folders of the groups that have
them all, and puts the exact question to their rows. So it finds what a scan of all rows
finds; terms too short for a piece are answered by that scan.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lastro.functions.text import fold_accents
from lastro.operators import quality as Q
from lastro.sources import storage

PIECE = 3
#: Postings that a term is met with; more would be read than they sort out.
RAREST = 3


def _pieces(text: Column, kind: str) -> Column:
    count = F.length(text) - (PIECE - 1)
    each = F.transform(F.sequence(F.lit(1), count), lambda i: F.concat(F.lit(kind), F.substring(text, i, F.lit(PIECE))))
    return F.when(count > 0, F.array_distinct(each)).otherwise(F.array().cast("array<string>"))


def _whole(text: Column, kind: str) -> Column:
    return F.when(text.isNotNull(), F.array(F.concat(F.lit(kind), text))).otherwise(F.array().cast("array<string>"))


class ClientIndex:
    """An index below a folder; ``buckets`` is fixed when it is built."""

    def __init__(self, spark: SparkSession, path: str, buckets: int = 64) -> None:
        self.spark, self.path, self.buckets = spark, path.rstrip("/"), buckets

    def _bucket(self, column: Column) -> Column:
        return F.pmod(F.xxhash64(column), F.lit(self.buckets)).cast("int")

    def build(self, frame: DataFrame) -> None:
        """Rows, postings and counts of a contract frame, in a folder that holds none yet."""
        alone = F.xxhash64(F.lit("sem"), *(F.col(f"`{name}`") for name in frame.columns))
        rows = frame.withColumn("_grupo", F.when(F.col("cpf_titular").isNotNull(), F.xxhash64("cpf_titular")).otherwise(alone))
        rows = rows.withColumn("_balde", self._bucket(F.col("_grupo")))
        rows.repartition("_balde").write.partitionBy("_balde").parquet(f"{self.path}/linhas")
        digits = lambda name: F.regexp_replace(name, r"\D", "")
        # A client's sales repeat the name and the numbers, so these are cut into pieces once per spelling.
        contacts = rows.select("_grupo", "nome_cliente", "telefone", "cpf_titular").distinct()
        tokens = F.concat(
            _pieces(F.coalesce(F.upper(fold_accents(F.col("nome_cliente"))), F.lit("")), "n"),
            _pieces(F.coalesce(digits("telefone"), F.lit("")), "t"), _whole(digits("cpf_titular"), "c"),
        )
        sales = rows.select("_grupo", F.explode(_whole(F.col("num_venda"), "v")).alias("token"))
        postings = contacts.select("_grupo", F.explode(tokens).alias("token")).unionAll(sales).distinct()
        dealt = postings.withColumn("_balde", self._bucket(F.col("token")))
        dealt.repartition("_balde").sortWithinPartitions("_balde", "token").write.partitionBy("_balde").parquet(f"{self.path}/postos")
        counts = self.spark.read.parquet(f"{self.path}/postos").groupBy("_balde", "token").agg(F.count(F.lit(1)).alias("n"))
        counts.repartition("_balde").sortWithinPartitions("_balde", "token").write.partitionBy("_balde").parquet(f"{self.path}/contagens")

    def _open(self, level: str, buckets: list[int]) -> DataFrame:
        """Some folders of a level; those that have rows."""
        root = f"{self.path}/{level}"
        held = [place for place in (f"{root}/_balde={bucket}" for bucket in sorted(set(buckets))) if storage.names(self.spark, place)]
        schema = self.spark.read.parquet(root).schema
        if not held:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).option("basePath", root).parquet(*held)

    def _terms(self, tax_id: str | None, name: str | None, phone: str | None, sale: str | None) -> list[tuple[list[str], list[int]]] | None:
        """Tokens and their folders of each term that is asked for; None if one is too short for the index."""
        wanted_id, wanted_phone = (re.sub(r"\D", "", term or "") for term in (tax_id, phone))
        wanted_sale, named = (sale or "").strip(), F.upper(F.trim(fold_accents(F.lit(name or ""))))
        asked = []
        if wanted_id:
            asked.append(_whole(F.lit(wanted_id.zfill(11)), "c"))
        if (name or "").strip():
            asked.append(_pieces(named, "n"))
        if wanted_phone:
            asked.append(_pieces(F.lit(wanted_phone), "t"))
        if wanted_sale:
            asked.append(_whole(F.lit(wanted_sale), "v"))
        if not asked:
            raise ValueError("give at least one search term")
        told = [F.transform(tokens, lambda token: F.struct(token.alias("token"), self._bucket(token).alias("balde"))) for tokens in asked]
        row = self.spark.range(1).select(F.array(*told).alias("termos")).first()
        terms = [([each["token"] for each in term], [each["balde"] for each in term]) for term in row["termos"]]
        return terms if all(tokens for tokens, _ in terms) else None

    def candidates(self, terms: list[tuple[list[str], list[int]]]) -> DataFrame:
        """``_grupo``: groups that hold the rarest tokens of any term."""
        found = []
        for tokens, buckets in terms:
            counts = self._open("contagens", buckets).where(F.col("token").isin(tokens)).orderBy("n", "token").collect()  # a row per token
            if len(counts) < len(tokens):
                continue  # a token that no group has
            rarest = [(row["token"], row["_balde"]) for row in counts[:RAREST]]
            held = self._open("postos", [bucket for _, bucket in rarest]).where(F.col("token").isin([token for token, _ in rarest]))
            found.append(held.groupBy("_grupo").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") == len(rarest)).select("_grupo"))
        if not found:
            return self.spark.createDataFrame([], "_grupo long")
        return reduce(DataFrame.unionAll, found).distinct()

    def search(self, tax_id: str | None = None, name: str | None = None, phone: str | None = None, sale: str | None = None) -> DataFrame:
        """The rows of ``client_lookup`` for the same terms."""
        terms = self._terms(tax_id, name, phone, sale)
        if terms is None:
            rows = self.spark.read.parquet(f"{self.path}/linhas")
        else:
            groups = self.candidates(terms)
            buckets = [row[0] for row in groups.select(self._bucket(F.col("_grupo"))).distinct().collect()]
            rows = self._open("linhas", buckets).join(groups, "_grupo", "left_semi")
        return Q.client_lookup(rows.drop("_grupo", "_balde"), tax_id, name, phone, sale)
