"""Column names and types of every layer."""

from pyspark.sql.types import (
    DateType,
    DoubleType,
    LongType,
    StringType,
    StructField,
    StructType,
)


def _schema(**types) -> StructType:
    return StructType([StructField(name, kind) for name, kind in types.items()])


BRONZE = _schema(
    id_transaccion=StringType(),
    id_usuario=StringType(),
    monto_str=StringType(),
    fecha_operacion=StringType(),
    categoria_raw=StringType(),
    tipo_movimiento=StringType(),
)

SILVER = _schema(
    id_transaccion=StringType(),
    id_usuario=StringType(),
    monto=DoubleType(),
    fecha=DateType(),
    categoria=StringType(),
    tipo_transaccion=StringType(),
)

BALANCE = _schema(
    tipo_transaccion=StringType(),
    total_monto=DoubleType(),
    total_operaciones=LongType(),
)

CATEGORY_SPEND = _schema(categoria=StringType(), total_gastado=DoubleType())

USER_TOTALS = _schema(
    id_usuario=StringType(),
    tipo_transaccion=StringType(),
    monto_total=DoubleType(),
)


def check_schema(df, expected: StructType):
    """Return ``df`` if its column names and types are the expected ones, else raise."""
    found = [(f.name, f.dataType) for f in df.schema]
    wanted = [(f.name, f.dataType) for f in expected]
    if found != wanted:
        raise ValueError(f"schema mismatch: expected {wanted}, found {found}")
    return df
