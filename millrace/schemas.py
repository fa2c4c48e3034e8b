"""Fixed record layouts used by more than one module."""

from __future__ import annotations

from pyspark.sql import types as T


def record(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


def listed(**fields: T.DataType) -> T.ArrayType:
    return T.ArrayType(record(**fields))


STRING, INT = T.StringType(), T.IntegerType()

# One reservation message. Parsing with a declared schema keeps the corrupt
# column stable: inference would only add it when a bad row is present.
RESERVATION = record(
    lastupdatetime=STRING,
    reservation=record(
        creationDateTime=STRING,
        creatorID=STRING,
        reservationConfirmations=listed(reservationCode=STRING, reservationInstance=STRING),
    ),
    property=record(propertyCode=STRING),
    reservationSegments=listed(
        segmentStatus=STRING,
        startDate=STRING,
        endDate=STRING,
        rate=record(
            ratePlanCode=STRING,
            baseRateUnit=STRING,
            baseAmount=T.DecimalType(18, 2),
            currencyCode=STRING,
            decimalPlaces=INT,
        ),
    ),
    roomPools=listed(roomPoolCode=STRING, numberOfUnits=INT),
    ratePlans=listed(marketCode=STRING),
    guest=listed(profiles=record(customer=listed(name=listed(givenName=STRING)))),
)
