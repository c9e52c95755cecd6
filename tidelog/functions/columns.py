"""Column expressions: routing, bit tests, time, JSON forms."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidelog.schema import DOCUMENTS, WITHOUT_SEQNO


def has_bits(bits: Column, mask: int) -> Column:
    return bits.bitwiseAND(F.lit(mask)) == mask


def shard_of(key: Column, shards: int) -> Column:
    """The shard of a key: bits 16 to 30 of its CRC-32, modulo the number of shards."""
    crc = F.crc32(key.cast("binary"))
    return F.pmod(F.shiftrightunsigned(crc, 16).bitwiseAND(F.lit(0x7FFF)), F.lit(shards)).cast("int")


def is_created(rev_seqno: Column) -> Column:
    return rev_seqno == 1


def is_document(kind: Column) -> Column:
    return kind.isin(*DOCUMENTS)


def event_seqno(kind: Column, seqno: Column) -> Column:
    """Null for the kinds that carry none."""
    return F.when(~kind.isin(*WITHOUT_SEQNO), seqno)


def before_cutoff(kind: Column, cas: Column, cutoff_ns: int) -> Column:
    """Whether a document event is older than the cutoff.

    The event's time is cut to whole seconds, the cutoff is not. A cutoff before
    the epoch drops nothing.
    """
    if cutoff_ns < 0:
        return F.lit(False)
    whole = (cas.cast("decimal(20,0)") - F.pmod(cas.cast("decimal(20,0)"), F.lit(10**9).cast("decimal(20,0)"))).cast("decimal(20,0)")
    return is_document(kind) & (F.lit(cutoff_ns).cast("decimal(20,0)") > whole)


def counts_for_flow(opcode: Column) -> Column:
    """Frames that earn flow credit, unknown ones in the range too."""
    return opcode.between(0x50, 0x65)


def is_newer_revision(epoch: Column, rev: Column, than_epoch: Column, than_rev: Column) -> Column:
    """Epochs decide first; within an epoch revision 0 always counts as newer."""
    return (epoch > than_epoch) | ((epoch == than_epoch) & ((rev == 0) | (rev > than_rev)))


def hex_number(text: Column) -> Column:
    """A hexadecimal number of up to 64 bits as bigint, from 2^63 on as its two's complement; null where it is none (conv alone would give 0)."""
    return F.when(text.rlike("^0*[0-9a-fA-F]{1,16}$"), F.conv(text, 16, -10).cast("bigint"))


def stream_filter_json(manifest_uid: Column, collections: Column, scope: Column, stream_id: Column) -> Column:
    """{uid, collections, scope, sid}: ids in lower-case hexadecimal, absent fields left out."""
    low = lambda c: F.lower(F.hex(c))
    ids = F.when(F.size(collections) > 0, F.transform(collections, lambda c: F.lower(F.hex(c))))
    return F.to_json(F.struct(low(manifest_uid).alias("uid"), ids.alias("collections"), low(scope).alias("scope"), stream_id.alias("sid")))


_LABEL = "[a-z0-9](?:[a-z0-9-]{0,61}[a-z0-9])?"


def is_identifier(text: Column, longest: int = 128) -> Column:
    """Visible ASCII only, at least one and at most `longest` characters: member ids, incarnations, uids."""
    return F.coalesce(text.rlike(rf"\A[!-~]{{1,{longest}}}\z"), F.lit(False))


def is_dns_label(text: Column) -> Column:
    """A lower-case DNS label of at most 63 characters: namespaces."""
    return F.coalesce(text.rlike(rf"\A{_LABEL}\z"), F.lit(False))


def is_dns_name(text: Column) -> Column:
    """Labels joined by dots, at most 253 characters: names of pods and of what owns them."""
    return F.coalesce((F.length(text) <= 253) & text.rlike(rf"\A{_LABEL}(?:\.{_LABEL})*\z"), F.lit(False))


def saturating_sum(count: Column) -> Column:
    """A sum that stays at the largest unsigned 64-bit number; an aggregate expression."""
    return F.least(F.sum(count.cast("decimal(38,0)")), F.lit(Decimal(2**64 - 1)).cast("decimal(38,0)")).cast("decimal(20,0)")
