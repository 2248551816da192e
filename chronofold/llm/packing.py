"""Filling fixed-capacity containers: best-two-fit over shards of bounded size."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..runtime import reach_package

RESULT = "budget_name string, container string, doc_id bigint, piece int, first_token bigint, n_tokens int"


def best_two_fit(sizes: list[int], capacity: int) -> list[list[int]]:
    """Bins of indices into sizes, none of which exceeds capacity.

    A bin starts with the largest unpacked item and takes the largest that fits, until none does. Then its smallest item gives way to the two
    unpacked items that together fill the gap it leaves best, if they fill it better than it did. Sets of free sizes are
    bit masks, so each step is a few operations on one integer. Items of size 0 go to the first bin.
    """
    ids: dict[int, list[int]] = {}
    for i in sorted(range(len(sizes)), reverse=True):
        ids.setdefault(sizes[i], []).append(i)
    zero = ids.pop(0, [])
    free = sum(1 << s for s in ids)  # bit s: an item of size s is unpacked
    mirror = sum(1 << (capacity - s) for s in ids)

    def take(s: int) -> int:
        nonlocal free, mirror
        i = ids[s].pop()
        if not ids[s]:
            free ^= 1 << s
            mirror ^= 1 << (capacity - s)
        return i

    def back(s: int, i: int) -> None:
        nonlocal free, mirror
        if not ids[s]:
            free |= 1 << s
            mirror |= 1 << (capacity - s)
        ids[s].append(i)

    bins: list[list[int]] = []
    while free:
        bin_, gap, least = [], capacity, 0
        while s := (free & ((1 << (gap + 1)) - 1)).bit_length() - 1:
            if s < 0:
                break
            bin_.append(take(s))
            gap -= s
            least = s  # sizes only fall
        if gap and free and least:
            room = gap + least
            for t in range(room, least, -1):
                both = free & (mirror >> (capacity - t)) & ((1 << t) - 1)
                half = t >> 1
                if not t & 1 and both >> half & 1 and len(ids[half]) < 2:
                    both ^= 1 << half
                if both:
                    a = both.bit_length() - 1
                    old = bin_.pop()
                    x, y = take(a), take(t - a)
                    bin_ += [x, y]
                    back(least, old)
                    break
        bins.append(bin_)
    if zero:
        if not bins:
            bins.append([])
        bins[0] += zero
    return bins


def pack(docs: DataFrame, budgets: list[tuple[str, int]], *, doc_id: str, n_tokens: str, n_docs: int, items_per_shard: int = 25_000) -> DataFrame:
    """The containers of every document under each budget.

    Documents are dealt by hash into shards of about items_per_shard documents, each packed by itself: with thousands of items a shard
    loses less than one container. A document longer than the capacity fills whole containers and leaves one rest, which is packed
    like any other item; no other document is split. Documents of no tokens get a container as well. A null doc_id is left out;
    repeated rows count once; a null n_tokens counts as 0; no documents or no budgets give no rows.
    Result: (budget_name, container, doc_id, piece, first_token, n_tokens), pieces numbered from 0.
    """
    spark = docs.sparkSession
    reach_package(spark)
    shards = max(1, -(-n_docs // items_per_shard))
    budgets = sorted({(n, int(c)) for n, c in budgets if n is not None and c is not None and c > 0})
    if not budgets:
        return spark.createDataFrame([], RESULT)
    per_doc = docs.where(F.col(doc_id).isNotNull()).groupBy(F.col(doc_id).cast("bigint").alias("doc_id")).agg(F.coalesce(F.max(n_tokens), F.lit(0)).cast("bigint").alias("n"))
    each = F.array(*[F.struct(F.lit(n).alias("budget_name"), F.lit(c).alias("capacity")) for n, c in budgets])
    rows = per_doc.withColumn("shard", F.pmod(F.xxhash64("doc_id"), F.lit(shards)).cast("int")).withColumn("_b", F.explode(each)).select("doc_id", "n", "shard", "_b.budget_name", "_b.capacity")

    def one(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("doc_id")
        name, cap, shard = pdf["budget_name"].iat[0], int(pdf["capacity"].iat[0]), int(pdf["shard"].iat[0])
        out, items, k = [], [], 0
        for d, n in zip(pdf["doc_id"].tolist(), pdf["n"].tolist()):
            whole = n // cap if n > cap else 0
            for p in range(whole):
                out.append((name, f"{name}:{shard}:{k}", d, p, p * cap, cap))
                k += 1
            if n > whole * cap or n == 0:
                items.append((d, whole, whole * cap, n - whole * cap))
        for bin_ in best_two_fit([x[3] for x in items], cap):
            out += [(name, f"{name}:{shard}:{k}", *items[i]) for i in bin_]
            k += 1
        return pd.DataFrame(out, columns=["budget_name", "container", "doc_id", "piece", "first_token", "n_tokens"])

    return rows.groupBy("budget_name", "shard").applyInPandas(one, RESULT)
