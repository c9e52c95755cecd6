"""Decoding of wire frames with Column expressions only.

Input is a DataFrame with `frame` (binary: a 24-byte header and a body). All
numbers are big-endian. What cannot be decoded gets a reason in `malformed` and
null fields instead of failing the job.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StringType, StructField, StructType

# Fixed values of the wire format.
REQUEST, ALT_REQUEST, RESPONSE, ALT_RESPONSE = 0x80, 0x08, 0x81, 0x18
LARGEST_BODY = 32 << 20
OPCODES = {
    0x55: "stream_end", 0x56: "snapshot_marker", 0x57: "mutation", 0x58: "deletion", 0x59: "expiration",
    0x5C: "noop", 0x5F: "system_event", 0x64: "seqno_advanced", 0x65: "oso_snapshot",
}
KEYED = (0x57, 0x58, 0x59)
END_REASONS = {0: "ok", 1: "closed", 2: "state_changed", 3: "disconnected", 4: "too_slow", 5: "backfill_failed", 7: "filter_empty"}
SYSTEM_KINDS = {0: "create_collection", 1: "drop_collection", 2: "flush_collection", 3: "create_scope", 4: "drop_scope", 5: "change_collection"}


def uint(data: Column, at: Column | int, size: int) -> Column:
    """An unsigned number of up to 8 bytes at a 0-based offset; decimal(20,0) for 8 bytes, else bigint."""
    at = F.lit(at) if isinstance(at, int) else at
    return _number(F.hex(F.substring(data, at + 1, F.lit(size))), 0, size)


def _number(digits: Column, at: Column | int, size: int) -> Column:
    """uint() over the hexadecimal text of the bytes, which is made once for many numbers."""
    part = F.substring(digits, (F.lit(at) if isinstance(at, int) else at) * 2 + 1, F.lit(2 * size))
    return F.conv(part, 16, 10).cast("decimal(20,0)") if size == 8 else F.conv(part, 16, 10).cast("bigint")


def seqno(digits: Column, at: int) -> Column:
    """A 64-bit seqno in hexadecimal text as bigint; null if it does not fit."""
    n = F.conv(F.substring(digits, 2 * at + 1, 16), 16, -10).cast("bigint")
    return F.when(n >= 0, n)


def uleb128(data: Column) -> Column:
    """struct(value, size) of an unsigned LEB128 number of at most 32 bits at the start; null if cut short, overlong or too large."""
    digits = F.hex(F.substring(data, 1, 5))
    # bytes with the highest bit set go on; the first without it is the last
    size = F.length(F.regexp_extract(digits, "^(?:[89A-F].){0,4}[0-7].", 0)) / 2
    byte = lambda i: F.conv(F.substring(digits, 2 * i + 1, 2), 16, 10).cast("bigint").bitwiseAND(F.lit(0x7F))
    value = byte(0)
    for i in range(1, 5):
        value = value + F.when(size > i, F.shiftleft(byte(i), 7 * i)).otherwise(0)
    return F.when((size > 0) & (value < 2**32), F.struct(value.alias("value"), size.cast("int").alias("size")))


def decode_frames(frames: DataFrame, collections: bool = True) -> DataFrame:
    """Header and body fields of each frame, beside the input's other columns. The header is put into hexadecimal text once."""
    h, frame = F.col("_head"), F.col("frame")
    x = frames.withColumn("_head", F.hex(F.substring(frame, 1, 24)))
    alt = F.substring(h, 1, 2).isin("08", "18")
    response = F.substring(h, 1, 2).isin("81", "18")
    x = x.withColumns({
        "magic": _number(h, 0, 1), "opcode": _number(h, 1, 1), "framing_length": F.when(alt, _number(h, 2, 1)).otherwise(0), "key_length": F.when(alt, _number(h, 3, 1)).otherwise(_number(h, 2, 2)),
        "extras_length": _number(h, 4, 1), "datatype": _number(h, 5, 1).cast("smallint"), "shard": F.when(~response, _number(h, 6, 2)).cast("int"), "status": F.when(response, _number(h, 6, 2)).cast("int"),
        "body_length": _number(h, 8, 4), "opaque": _number(h, 12, 4), "cas": _number(h, 16, 8), "_response": response,
    })
    fl, el, kl = F.col("framing_length"), F.col("extras_length"), F.col("key_length")
    malformed = (
        F.when(F.length("frame") < 24, "short header").when(~F.col("magic").isin(REQUEST, ALT_REQUEST, RESPONSE, ALT_RESPONSE), "unknown magic")
        .when(F.col("body_length") > LARGEST_BODY, "body too large").when(fl + kl + el > F.col("body_length"), "fields exceed body")
        .when(F.length("frame") < 24 + F.col("body_length"), "short body")
    )
    cut = lambda start, size: F.substring(frame, (start + 25).cast("int"), size.cast("int"))
    keyed = F.col("opcode").isin(*KEYED) & ~F.col("_response") & (kl > 0) & F.lit(collections)
    x = x.withColumns({"_malformed": malformed, "framing": F.when(fl > 0, cut(F.lit(0), fl)).otherwise(F.lit(b"")), "extras": cut(fl, el), "value": cut(fl + el + kl, F.col("body_length") - fl - el - kl), "_id": F.when(keyed, uleb128(cut(fl + el, kl))), "_keyed": keyed})
    skip = F.coalesce("_id.size", F.lit(0))
    return x.withColumns({
        "malformed": F.coalesce("_malformed", F.when(F.col("_keyed") & F.col("_id").isNull(), "bad collection prefix")),
        "collection_id": F.col("_id.value"), "key": cut(fl + el + skip, kl - skip), "wire_size": (F.lit(24) + F.col("body_length")).cast("int"), "stream_id": stream_id(F.col("framing")),
    }).drop("_head", "_id", "_keyed", "_malformed", "_response")


def be(number: Column, size: int) -> Column:
    """An unsigned number as big-endian bytes; up to 64 bits."""
    return F.unhex(F.lpad(F.conv(number.cast("string"), 10, 16), 2 * size, "0"))


def leb128(number: Column) -> Column:
    """An unsigned number of at most 32 bits as LEB128: the inverse of uleb128."""
    n = number.cast("bigint")
    byte = lambda i: F.shiftrightunsigned(n, 7 * i).bitwiseAND(F.lit(0x7F))
    size = F.lit(1)
    for i in range(1, 5):
        size = size + (n >= (1 << 7 * i)).cast("int")
    digits = [F.when(size > i, F.lpad(F.hex(byte(i) + F.when(size > i + 1, 128).otherwise(0)), 2, "0")).otherwise("") for i in range(5)]
    return F.unhex(F.concat(*digits))


def encode_frames(decoded: DataFrame) -> DataFrame:
    """decoded with `frame`, the inverse of decode_frames, and `problem`, with which there is no frame.

    Needs opcode; takes magic (a request without), framing, extras, key, value, collection_id
    (put before the key), datatype, shard or status, opaque and cas; a missing or null
    number is 0, missing bytes are none.
    """
    there = set(decoded.columns)
    data = lambda c: F.coalesce(F.col(c), F.lit(b"")) if c in there else F.lit(b"")
    number = lambda c, other=0: F.coalesce(F.col(c), F.lit(other)) if c in there else F.lit(other)
    prefix = F.when(F.col("collection_id").isNotNull() & F.col("opcode").isin(*KEYED), leb128(F.col("collection_id"))).otherwise(F.lit(b"")) if "collection_id" in there else F.lit(b"")
    x = decoded.withColumns({"_magic": number("magic", REQUEST), "_framing": data("framing"), "_extras": data("extras"), "_value": data("value"), "_key": F.concat(prefix, data("key"))})
    alt, response = F.col("_magic").isin(ALT_REQUEST, ALT_RESPONSE), F.col("_magic").isin(RESPONSE, ALT_RESPONSE)
    fl, el, kl, vl = (F.length(c) for c in ("_framing", "_extras", "_key", "_value"))
    body = fl + el + kl + vl
    large = F.coalesce(F.col("collection_id") >= 2**32, F.lit(False)) if "collection_id" in there else F.lit(False)
    problem = (
        F.when(~F.col("_magic").isin(REQUEST, ALT_REQUEST, RESPONSE, ALT_RESPONSE), "unknown magic").when(large, "collection id too large").when(~alt & (fl > 0), "framing extras need the other magic").when(fl > 255, "framing extras too long")
        .when(kl > F.when(alt, 255).otherwise(65_535), "key too long").when(el > 255, "extras too long").when(body > LARGEST_BODY, "body too large")
    )
    x = x.withColumn("problem", problem)
    lengths = F.when(alt, F.concat(be(fl, 1), be(kl, 1))).otherwise(be(kl, 2))
    target = F.when(response, number("status")).otherwise(number("shard"))
    head = F.concat(be(F.col("_magic"), 1), be(F.col("opcode"), 1), lengths, be(el, 1), be(number("datatype"), 1), be(target, 2), be(body, 4), be(number("opaque"), 4), be(number("cas"), 8))
    return x.withColumn("frame", F.when(F.col("problem").isNull(), F.concat(head, "_framing", "_extras", "_key", "_value"))).drop("_magic", "_framing", "_extras", "_key", "_value")


def stream_id(framing: Column) -> Column:
    """The 2-byte stream id (frame info 2) of framing extras; the last one wins. Info ids and sizes of 15 and more take a further byte."""
    byte = lambda i: F.conv(F.hex(F.substring(framing, i + 1, F.lit(1))), 16, 10).cast("int")

    def step(state: Column, i: Column) -> Column:
        b = byte(i)
        id_, size = F.floor(b / 16), F.pmod(b, F.lit(16))
        id_more, size_more = (id_ == 15).cast("int"), (size == 15).cast("int")
        whole_id = F.when(id_ == 15, F.lit(15) + byte(i + 1)).otherwise(id_)
        whole_size = F.when(size == 15, F.lit(15) + byte(i + 1 + id_more)).otherwise(size)
        data = i + 1 + id_more + size_more
        got = F.when((whole_id == 2) & (whole_size == 2), byte(data) * 256 + byte(data + 1)).otherwise(state["sid"])
        return F.when(i == state["at"], F.struct((data + whole_size).cast("int").alias("at"), got.cast("int").alias("sid"))).otherwise(state)

    start = F.struct(F.lit(0).alias("at"), F.lit(None).cast("int").alias("sid"))
    return F.when(F.length(framing) > 0, F.aggregate(F.sequence(F.lit(0), F.length(framing) - 1), start, step, lambda s: s["sid"]))


def _named(code: Column, names: dict[int, str]) -> Column:
    out = F.lit("unknown")
    for k, v in names.items():
        out = F.when(code == k, v).otherwise(out)
    return F.when(code.isNotNull(), out)


def decode_events(decoded: DataFrame) -> DataFrame:
    """Decoded request frames as change events; responses are malformed, no-ops leave, unknown opcodes stay as `unknown`.

    Extras and the part of the value that holds numbers are put into hexadecimal text
    once; a number is read only where the kind of event has it.
    """
    ex, vl = F.length("extras"), F.length("value")
    # told by its byte, so that the filter can go down to the scan
    x = decoded.where(F.substring("frame", 2, 1) != F.lit(b"\x5c")).withColumn("kind", _named(F.col("opcode"), OPCODES))
    k = F.col("kind")
    m, s, gone, doc = k == "snapshot_marker", k == "system_event", k.isin("deletion", "expiration"), k.isin("mutation", "deletion", "expiration")
    v2 = m & (ex == 1)
    x = x.withColumns({"_e": F.hex("extras"), "_v": F.when(s | v2, F.hex(F.substring("value", 1, 52)))})
    e, v = F.col("_e"), F.col("_v")
    data = F.when(v2, v).otherwise(e)
    on = lambda cond, c: F.when(cond, c)
    code, version = on(s, _number(e, 8, 4)), on(v2, _number(e, 0, 1))
    x = x.withColumns({
        "seqno": on(doc | s | (k == "seqno_advanced"), seqno(e, 0)), "rev_seqno": on(doc, seqno(e, 8)),
        "flags": on(k == "mutation", _number(e, 16, 4)), "expiry": on(k == "mutation", _number(e, 20, 4)), "lock_time": on(k == "mutation", _number(e, 24, 4)),
        "delete_time": on(gone & (ex >= 20), _number(e, 16, 4)),
        "snap_start": on(m, seqno(data, 0)), "snap_end": on(m, seqno(data, 8)), "snap_flags": on(m, _number(data, 16, 4)),
        "max_visible_seqno": on(v2, seqno(v, 20)), "high_completed_seqno": on(v2, seqno(v, 28)),
        "snap_timestamp": on(v2 & (version >= 1), seqno(v, 36)), "purge_seqno": on(v2 & (version >= 2), seqno(v, 44)), "_version": version,
        "end_reason_code": on(k == "stream_end", _number(e, 0, 4)), "sys_code": code, "sys_version": on(s, _number(e, 12, 1).cast("smallint")),
        "_oso": on(k == "oso_snapshot", _number(e, 0, 4)),
    })
    code, version = F.col("sys_code"), F.col("_version")
    least = F.create_map(*[F.lit(y) for kv in {"mutation": 28, "deletion": 16, "expiration": 16, "stream_end": 4, "seqno_advanced": 8, "system_event": 13, "oso_snapshot": 4}.items() for y in kv])
    v2_least = F.when(version >= 2, 52).when(version >= 1, 44).otherwise(36)
    sys_least = F.when(code == 0, F.when(F.col("sys_version") >= 1, 20).otherwise(16)).when(code.isin(1, 5), 16).when(code.isin(2, 3, 4), 12).otherwise(8)
    bad = (
        F.when(F.col("status").isNotNull(), "response").when(F.try_element_at(least, k) > ex, "short extras")
        .when(s & (vl < sys_least), "short system event").when(m & ~v2 & (ex < 20), "short extras").when(v2 & (vl < v2_least), "short marker").when(m & (F.col("snap_start") > F.col("snap_end")), "marker start after end")
        .when((doc | s | (k == "seqno_advanced")) & F.col("seqno").isNull(), "seqno too large")
    )
    return x.withColumns({
        "end_reason": _named(F.col("end_reason_code"), END_REASONS), "sys_kind": _named(code, SYSTEM_KINDS), "oso_state": _named(F.col("_oso"), {0: "begin", 1: "end"}),
        "manifest_uid": on(s, seqno(v, 0)), "scope_id": on(s & code.isin(0, 1, 3, 4), _number(v, 8, 4)),
        "collection_id": F.coalesce("collection_id", on(s & code.isin(0, 1, 2, 5), _number(v, F.when(code.isin(2, 5), 8).otherwise(12), 4))),
        "max_ttl": F.when(s & (code == 0) & (F.col("sys_version") >= 1), _number(v, 16, 4)).when(s & (code == 5), _number(v, 12, 4)),
        "sys_data": on(s, F.col("value")), "malformed": F.coalesce("malformed", bad),
    }).drop("_oso", "_e", "_v", "_version")


#: A value larger than this when decompressed is refused, as a body is.
LARGEST_VALUE = 32 << 20
SNAPPY = 2  # the datatype bit


def decompressed(decoded: DataFrame, negotiated: bool = True) -> DataFrame:
    """decoded with snappy values (raw blocks) in plain form and their datatype bit cleared; others as they are.

    Without negotiation, with a broken block or a length above LARGEST_VALUE, the row
    gets a reason in `malformed` and a null value.
    """
    packed = F.col("datatype").bitwiseAND(F.lit(SNAPPY)) != 0
    plain = F.when(packed & F.lit(negotiated), _snappy("value"))
    x = decoded.withColumns({"_plain": plain, "_packed": packed}).withColumn("malformed", F.coalesce("malformed", F.when(F.col("_packed"), F.coalesce(F.col("_plain.problem"), F.lit(None if negotiated else "compression was not negotiated").cast("string")))))
    clear = (F.col("datatype") - SNAPPY).cast("smallint")
    return x.withColumns({"value": F.when(F.col("_packed"), F.col("_plain.value")).otherwise(F.col("value")), "datatype": F.when(F.col("_packed"), clear).otherwise(F.col("datatype"))}).drop("_plain", "_packed")


_PLAIN = StructType([StructField("value", BinaryType()), StructField("problem", StringType())])


@F.pandas_udf(_PLAIN)
def _snappy(values: pd.Series) -> pd.DataFrame:
    import pyarrow as pa

    codec, out = pa.Codec("snappy"), []
    for v in values:
        try:
            size = shift = 0
            for i, b in enumerate(v[:5] if v is not None else b""):  # the block begins with its plain length
                size, shift = size | (b & 127) << shift, shift + 7
                if b < 128:
                    break
            else:
                raise ValueError
            out.append((None, "value too large") if size > LARGEST_VALUE else (codec.decompress(v, size, asbytes=True), None))
        except (ValueError, OSError):
            out.append((None, "bad snappy value"))
    return pd.DataFrame(out, columns=["value", "problem"])


# Response statuses.
NOT_FOUND, PATHS_FAILED, PATH_NOT_FOUND = 0x01, 0xCC, 0xC0


def lookup_value(status: Column, value: Column) -> Column:
    """struct(value, problem) of a one-path lookup response: a missing document or path has neither."""
    own, size = uint(value, 0, 2), uint(value, 2, 4)
    problem = (
        F.when(status == NOT_FOUND, None).when(~status.isin(0, PATHS_FAILED), "status").when(F.length(value) < 6, "short result").when(F.length(value) != size + 6, "wrong length")
        .when(~own.isin(0, PATH_NOT_FOUND), "path status")
    )
    there = status.isin(0, PATHS_FAILED) & (F.length(value) >= 6) & (F.length(value) == size + 6) & (own == 0)
    return F.struct(F.when(there, F.substring(value, F.lit(7), F.length(value))).alias("value"), problem.alias("problem"))


def collection_id_response(status: Column, extras: Column) -> Column:
    """struct(manifest_uid, collection_id) of a successful response with 12 bytes of extras; else null."""
    return F.when((status == 0) & (F.length(extras) == 12), F.struct(uint(extras, 0, 8).alias("manifest_uid"), uint(extras, 8, 4).alias("collection_id")))


def records(value: Column, size: int, fields: dict[str, tuple[int, int]]) -> Column:
    """An array of structs from fixed-size records; null if the length is no multiple of the size."""
    n = F.length(value)
    at = F.when(n > 0, F.sequence(F.lit(0), n - size, F.lit(size))).otherwise(F.array().cast("array<int>"))
    one = lambda i: F.struct(*[uint(value, i + o, w).alias(k) for k, (o, w) in fields.items()])
    return F.when(F.pmod(n, F.lit(size)) == 0, F.transform(at, one))


def seqno_list(value: Column) -> Column:
    return records(value, 10, {"shard": (0, 2), "seqno": (2, 8)})


def failover_list(value: Column) -> Column:
    return records(value, 16, {"branch": (0, 8), "seqno": (8, 8)})


def stream_response(status: Column, value: Column) -> Column:
    """struct(rollback, log): status 0x23 carries the seqno to go back to in exactly 8 bytes; status 0 the failover log."""
    return F.struct(F.when((status == 0x23) & (F.length(value) == 8), uint(value, 0, 8)).alias("rollback"), F.when(status == 0, failover_list(value)).alias("log"))


def observe_response(value: Column) -> Column:
    """struct of an observe response: format 0 (27 bytes at least), or 1 (43) after a hard failover; else null."""
    fmt = uint(value, 0, 1)
    good = ((fmt == 0) & (F.length(value) >= 27)) | ((fmt == 1) & (F.length(value) >= 43))
    return F.when(good, F.struct(
        (fmt == 1).alias("did_failover"), uint(value, 1, 2).cast("int").alias("shard"), uint(value, 3, 8).alias("branch"), uint(value, 11, 8).alias("persisted"), uint(value, 19, 8).alias("current"),
        F.when(fmt == 1, uint(value, 27, 8)).alias("old_branch"), F.when(fmt == 1, uint(value, 35, 8)).alias("last_seqno"),
    ))
