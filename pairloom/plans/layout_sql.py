"""SQL that says the same as the queries of :mod:`pairloom.plans.layout`."""

from __future__ import annotations

from pairloom.functions.geometry import aspect_bounds
from pairloom.plans.ingest import _TOK, _ID, _VALID, sql_has
from pairloom.plans.layout import BATCH, BLOCK, BUCKETS, EPOCH, LONGEST, SEED, TARGET, TOKENS, WORLD

#: Is the file a whole PNG: it begins with the mark and ends with the last chunk.
WHOLE_PNG = "(hex(coalesce(image_bytes, ''::BLOB)) LIKE '89504E470D0A1A0A%0000000049454E44AE426082')"

_DIMS = "(SELECT o_orderkey AS id, CAST(64 + (o_orderkey * 7919) % 4033 AS INTEGER) AS w, CAST(64 + (o_orderkey * 104729) % 4033 AS INTEGER) AS h FROM orders)"
_D = "CAST({x} AS DOUBLE)"


def _div(a: object, b: str) -> str:
    return f"(CAST({a} AS DOUBLE) / CAST({b} AS DOUBLE))"


def _bucket(w: str, h: str) -> str:
    cases = " ".join(f"WHEN CAST({_div(w, h)} AS FLOAT) < CAST({b!r} AS FLOAT) THEN {i}" for i, b in enumerate(aspect_bounds(BUCKETS)))
    return f"CASE WHEN {h} <> 0 THEN CASE {cases} ELSE {BUCKETS - 1} END END"


def _key(seed: object, epoch: int, id_: str) -> str:
    return f"md5('{seed}:{epoch}:' || {id_})"


def _order(seed: object, id_: str) -> str:
    return f"ORDER BY {_key(seed, 0, id_)}, {id_}"


_MIN = "least({a}, {b})".format(a=_div(TARGET, "w"), b=_div(TARGET, "h"))
_MAX = "greatest({a}, {b})".format(a=_div(TARGET, "w"), b=_div(TARGET, "h"))
_NW, _NH = (f"CAST(floor({x} * {_MIN}) AS INTEGER)" for x in "wh")
_CW, _CH = (f"CAST(floor({x} * {_MAX}) AS INTEGER)" for x in "wh")


def _preserve(longest: int) -> str:
    s = f"least({_div(longest, 'w')}, {_div(longest, 'h')})"
    return ", ".join(f"CASE WHEN w >= 1 AND h >= 1 THEN CASE WHEN {s} < 1 THEN greatest(1, CAST(floor({x} * {s}) AS INTEGER)) ELSE {x} END END AS actual_{x}" for x in "wh")


_ENTRIES = "(SELECT shard_id, max(lower(trim(shard_path))) AS shard_path, max(format_version) AS format_version, max(sample_count) AS sample_count, max(size_bytes) AS size_bytes, max(lower(checksum_crc32)) AS checksum_crc32 FROM shards GROUP BY shard_id)"
_DEALT = f"(SELECT *, CAST((row_number() OVER (ORDER BY shard_path, shard_id) - 1) % {WORLD} AS INTEGER) AS rank FROM {_ENTRIES})"
_ADDRESS = "(SELECT row_number() OVER (ORDER BY shard_id, local_index) - 1 AS global_index, shard_id, local_index, row_index FROM (SELECT shard_id, local_index, min(row_index) AS row_index FROM shard_records GROUP BY shard_id, local_index))"
_EPOCH = f"(SELECT row_index, row_number() OVER ({_order(SEED + EPOCH, 'row_index')}) - 1 AS position FROM samples WHERE {_VALID})"
_RECORDS = "(SELECT row_index, max(actual_width) AS w, max(actual_height) AS h, max(q_len) AS q, max(a_len) AS a FROM shard_records GROUP BY row_index)"
_BATCHED = f"(SELECT *, CAST(floor((row_number() OVER ({_order(SEED + EPOCH, 'row_index')}) - 1) / {BATCH}) AS BIGINT) AS batch_id FROM {_RECORDS})"
_OFFSETS = "(SELECT *, 64 + coalesce(sum(CAST(ceil(rec_len / 64.0) AS BIGINT) * 64) OVER (PARTITION BY shard_id ORDER BY local_index ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS off FROM (SELECT shard_id, local_index, max(rec_len) AS rec_len, max(rec_offset) AS stored FROM shard_records GROUP BY shard_id, local_index))"
_PIXEL = "least(255, greatest(0, floor((CAST(x AS DOUBLE) + 1) * CAST(127.5 AS DOUBLE))))"
_META = "coalesce(octet_length(encode(metadata['model_reasoning'])), 0)"
_LEN = f"(8 + 3 * CAST(image_height AS BIGINT) * image_width + 16 * 128 + 4 + {_META})"

ORACLES = {
    "resize_and_pad_geometry": f"SELECT id, new_w, new_h, CAST(floor(({TARGET} - new_w) / 2.0) AS INTEGER) AS pad_left, CAST(floor(({TARGET} - new_h) / 2.0) AS INTEGER) AS pad_top FROM (SELECT id, {_NW} AS new_w, {_NH} AS new_h FROM {_DIMS})",
    "center_crop_geometry": f"SELECT id, new_w, new_h, CAST(floor((new_w - {TARGET}) / 2.0) AS INTEGER) AS crop_left, CAST(floor((new_h - {TARGET}) / 2.0) AS INTEGER) AS crop_top FROM (SELECT id, {_CW} AS new_w, {_CH} AS new_h FROM {_DIMS})",
    "resize_preserve_geometry": f"SELECT id, {_preserve(LONGEST)} FROM {_DIMS}",
    "sample_geometry": f"SELECT row_index, {_preserve(20)} FROM (SELECT row_index, image_width AS w, image_height AS h FROM samples)",
    "ar_bucket": f"SELECT id, {_bucket('w', 'h')} AS bucket_id FROM {_DIMS}",
    "ar_bucket_batches": f"SELECT id, bucket_id, CAST(floor((row_number() OVER (PARTITION BY bucket_id ORDER BY id) - 1) / {BATCH}) AS BIGINT) AS bucket_batch FROM (SELECT id, {_bucket('w', 'h')} AS bucket_id FROM {_DIMS})",
    "bucket_histogram": f"SELECT {_bucket('image_width', 'image_height')} AS bucket_id, count(*) AS samples FROM samples WHERE image_width > 0 AND image_height > 0 GROUP BY 1",
    "deferred_normalize": f"SELECT vec_id, pos, CAST({_PIXEL} AS INTEGER) AS pixel, round({_PIXEL} * CAST({1.0 / (255.0 * 0.229)!r} AS DOUBLE) + CAST({-0.485 / 0.229!r} AS DOUBLE), 4) AS value FROM (SELECT vec_id, unnest(embedding) AS x, generate_subscripts(embedding, 1) - 1 AS pos FROM embeddings)",
    "global_shuffle": f"SELECT o_orderkey, row_number() OVER ({_order(SEED, 'o_orderkey')}) - 1 AS position FROM orders",
    "epoch_shuffle": f"SELECT row_index, row_number() OVER ({_order(SEED + EPOCH, 'row_index')}) - 1 AS position FROM samples",
    "local_shuffle": f"SELECT shard_id, row_index, row_number() OVER (PARTITION BY shard_id {_order(SEED, 'row_index')}) - 1 AS position FROM (SELECT DISTINCT shard_id, row_index FROM shard_records)",
    "block_shuffle": f"SELECT row_index, position, b * {BLOCK} + row_number() OVER (PARTITION BY b {_order(SEED, 'row_index')}) - 1 AS shuffled FROM (SELECT row_index, position, CAST(floor(position / {BLOCK}) AS BIGINT) AS b FROM (SELECT row_index, row_number() OVER (ORDER BY row_index) - 1 AS position FROM samples))",
    "shard_assign_streaming": f"SELECT row_index, dense_rank() OVER (ORDER BY chunk) - 1 AS shard_id, row_number() OVER (PARTITION BY chunk ORDER BY row_index) - 1 AS local_index FROM (SELECT *, CAST(floor((row_number() OVER (ORDER BY row_index) - 1) / 100) AS BIGINT) AS chunk FROM samples) WHERE {_VALID}",
    "shard_assign_compact": f"SELECT row_index, CAST(floor(p / 100) AS BIGINT) AS shard_id, p % 100 AS local_index FROM (SELECT row_index, row_number() OVER (ORDER BY row_index) - 1 AS p FROM samples WHERE {_VALID})",
    "shard_assign_by_size": "SELECT doc_id, CAST(floor(b / 65536) AS BIGINT) AS shard_id FROM (SELECT doc_id, coalesce(sum(coalesce(octet_length(encode(text)), 0)) OVER (ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS b FROM documents)",
    "shard_path": "SELECT DISTINCT shard_id, printf('shard_%04d.bin', shard_id) AS path FROM shards",
    "record_length": f"SELECT row_index, {_LEN} AS rec_len, CAST(ceil({_LEN} / 64.0) AS BIGINT) * 64 AS aligned_len, 3 * {TARGET} * {TARGET} * 4 + 16 * 128 + 4 + {_META} AS v1_len FROM samples WHERE image_width >= 1 AND image_height >= 1",
    "offset_table": f"SELECT shard_id, local_index, rec_len, CAST(off AS BIGINT) AS rec_offset FROM {_OFFSETS}",
    "offset_faults": f"SELECT shard_id, count(*) FILTER (stored <> off) AS differing, count(*) AS records FROM {_OFFSETS} GROUP BY shard_id",
    "run_summary": f"SELECT total, processed, total - processed AS error_samples, CAST(ceil(processed / 100.0) AS BIGINT) AS shards FROM (SELECT count(*) AS total, count(*) FILTER ({_VALID}) AS processed FROM samples)",
    "manifest_shards": f"SELECT * FROM {_ENTRIES}",
    "manifest_totals": f"SELECT count(*) AS total_shards, CAST(coalesce(sum(sample_count), 0) AS BIGINT) AS total_samples, CAST(coalesce(sum(size_bytes), 0) AS BIGINT) AS total_bytes FROM {_ENTRIES}",
    "manifest_check": f"SELECT shard_id, sample_count, samples, payload_bytes, sample_count - samples AS off_by FROM (SELECT shard_id, sample_count FROM {_ENTRIES}) FULL JOIN (SELECT shard_id, count(*) AS samples, CAST(sum(rec_len) AS BIGINT) AS payload_bytes FROM (SELECT shard_id, local_index, max(rec_len) AS rec_len FROM shard_records GROUP BY shard_id, local_index) GROUP BY shard_id) USING (shard_id)",
    "manifest_rollup": f"SELECT coalesce(rank, -1) AS rank, CAST(sum(sample_count) AS BIGINT) AS samples, CAST(sum(size_bytes) AS BIGINT) AS bytes, count(*) AS shards FROM {_DEALT} GROUP BY ROLLUP (rank)",
    "assign_shards_rr": f"SELECT shard_path, rank FROM {_DEALT}",
    "rank_load": f"SELECT rank, count(*) AS shards, CAST(sum(sample_count) AS BIGINT) AS samples FROM {_DEALT} GROUP BY rank",
    "rank_overlap": f"SELECT ranks, count(*) AS shards FROM (SELECT shard_id, count(DISTINCT rank) AS ranks FROM {_DEALT} GROUP BY shard_id) GROUP BY ranks",
    "address_table": f"SELECT * FROM {_ADDRESS}",
    "partition_contiguous": f"SELECT global_index, shard_id, CAST(floor(global_index / ceil((SELECT count(*) FROM {_ADDRESS}) / {float(WORLD)})) AS INTEGER) AS rank FROM {_ADDRESS}",
    "partition_interleaved": f"SELECT global_index, shard_id, CAST(global_index % {WORLD} AS INTEGER) AS rank FROM {_ADDRESS}",
    "verify_partition": f"SELECT count(*) - count(DISTINCT global_index) + (max(global_index) + 1 - count(DISTINCT global_index)) + min(global_index) AS faults, count(*) AS indices FROM {_ADDRESS}",
    "epoch_batches": f"SELECT row_index, position, CAST(floor(position / {BATCH}) AS BIGINT) AS batch_id, CAST(position % {WORLD} AS INTEGER) AS rank FROM {_EPOCH}",
    "checkpoint_resume": f"SELECT row_index, CAST(floor(position / {BATCH}) AS BIGINT) AS batch_id FROM {_EPOCH} WHERE floor(position / {BATCH}) >= 100",
    "point_lookup": "SELECT shard_id, min(row_index) AS row_index, max(rec_len) AS rec_len FROM shard_records WHERE local_index = 7 GROUP BY shard_id",
    "batch_by_indices": "SELECT DISTINCT shard_id, local_index, row_index FROM shard_records WHERE local_index IN (3, 14, 15, 92, 65)",
    "flag_bits": "SELECT DISTINCT shard_id, (f & 1) <> 0 AS uint8, (f & 2) <> 0 AS sample_dims, (f & 4) <> 0 AS lz4, (f & 8) <> 0 AS zstd FROM (SELECT shard_id, CAST(shard_id % 16 AS INTEGER) AS f FROM shards)",
    "batch_pad_dims": f"SELECT batch_id, count(*) AS batch_size, max(h) AS max_h, max(w) AS max_w, greatest(1, max(greatest(coalesce(q, 0), coalesce(a, 0)))) AS max_t FROM {_BATCHED} GROUP BY batch_id",
    "padding_waste": f"SELECT batch_id, round(1 - CAST(sum(CAST(h AS BIGINT) * w) AS DOUBLE) / CAST(count(*) * max(h) * max(w) AS DOUBLE), 6) AS waste FROM {_BATCHED} GROUP BY batch_id",
    "batch_token_trim": f"SELECT batch_id, greatest(1, max(greatest(least(q, {TOKENS}), least(a, {TOKENS})))) AS tokens_kept FROM (SELECT len({_TOK.format(c='question')}) AS q, len({_TOK.format(c='answer')}) AS a, CAST(floor((row_number() OVER ({_order(SEED + EPOCH, 'row_index')}) - 1) / {BATCH}) AS BIGINT) AS batch_id FROM samples WHERE {sql_has('question')} AND {sql_has('answer')}) GROUP BY batch_id",
    "collate_fixed": f"SELECT batch_id, count(*) AS batch_size, {', '.join(f'md5(string_agg({x}, chr(44) ORDER BY position)) AS {x}_md5' for x in ('q_ids', 'q_mask', 'a_ids', 'a_mask'))}, count(*) FILTER (whole) AS images, count(*) * 3 * 384 * 384 * 4 AS pixel_bytes FROM (SELECT position, CAST(floor(position / {BATCH}) AS BIGINT) AS batch_id, whole, {', '.join(f'array_to_string(list_resize({x}, {TOKENS}, 0), chr(44)) AS {x}_ids, array_to_string(list_resize(list_transform({x}, lambda y: 1), {TOKENS}, 0), chr(44)) AS {x}_mask' for x in 'qa')} FROM (SELECT row_number() OVER ({_order(SEED + EPOCH, 'row_index')}) - 1 AS position, {WHOLE_PNG} AS whole, {', '.join(f'list_transform({_TOK.format(c=c)}, lambda x: {_ID.format(t=chr(120))}) AS {k}' for k, c in (('q', 'question'), ('a', 'answer')))} FROM samples)) GROUP BY batch_id",
}
