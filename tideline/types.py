"""Row shapes of the change feed and its tables."""

from __future__ import annotations

from pyspark.sql import types as T

_S, _L, _I, _TS, _MAP = T.StringType(), T.LongType(), T.IntegerType(), T.TimestampType(), T.MapType(T.StringType(), T.StringType())


def shape(**fields: T.DataType) -> T.StructType:
    """Struct of nullable fields."""
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


SEQUENCER = shape(csn=T.DecimalType(38, 0), pos=T.DecimalType(38, 0), is_pk_change=_L)
WRAPPER = shape(table_name=_S, schema_fingerprint=_L, payload=T.BinaryType())
PAYLOAD = shape(table=_S, op_type=_S, op_ts=_S, current_ts=_S, pos=_S, xid=_S, csn=_S, txind=_S, primary_keys=T.ArrayType(_S), before=_S, after=_S)
COMPLETED_BATCH = shape(app=_S, stream_name=_S, streaming_query_id=_S, batch_id=_S, completed_at=_TS, yyyymm=_I)
FLOW_ERROR = shape(error_id=_S, app=_S, flow_id=_S, error_desc=_S, error_trace=_S, error_metadata=_MAP, created_by=_S, created_at=_TS, yyyymm=_I)
LOAD_STATUS = shape(src_db=_S, src_schema=_S, load_status=_S, failure_reason=_S, job_details=_MAP, created_at=_TS, updated_at=_TS)
DOCUMENT = shape(document_id=_S, document=T.VariantType(), org_id=_S, event_date=T.DateType(), schema_id=_S, __meta=_MAP)
#: Columns that the apply step keeps beside the business columns.
SYSTEM_COLUMNS = ("__sk", "__schema_id", "__cdc_sequencer", "__meta", "__DeleteVersion", "__UpsertVersion")
