"""Report contracts: which source positions are read, what they are called,
and the final typed output.  Immutable, so a second load in the same process
sees the same columns (the reference mutated its lists in place)."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql.types import StringType, StructField, StructType


@dataclass(frozen=True)
class ReportSpec:
    name: str
    positions: tuple[int, ...]          # source cell positions, in read order
    raw_names: tuple[str, ...]          # names given to those cells
    output: tuple[tuple[str, str], ...]  # final (name, spark type), in order
    date_column: str                    # drives cut-off and audit dates
    table: str                          # target table
    preview: tuple[str, ...]            # columns of the newest-rows preview

    @property
    def raw_schema(self) -> StructType:
        return StructType([StructField(n, StringType(), True) for n in self.raw_names])

    @property
    def raw_ddl(self) -> str:
        return ", ".join(f"`{n}` string" for n in self.raw_names)

    @property
    def output_names(self) -> list[str]:
        return [n for n, _ in self.output]

    @property
    def output_ddl(self) -> str:
        return ", ".join(f"`{n}` {t}" for n, t in self.output)


# The report layouts (positions, names and output order) are the
# data contract of the source reports and the target tables.
SD_SPEC = ReportSpec(
    name="SD",
    positions=(0, 1, 5, 6, 7, 8, 9, 10, 11, 12, 13, 14, 15, 16, 17),
    raw_names=("TIPO_DOC", "NRO_DOC", "NOMBRE_CLIENTE", "FECHA_NAC", "TIPO_ENTIDAD", "FECHA_REG",
               "FUENTE", "NACIONALIDAD", "RAMOS", "COD_BROKER", "BROKER", "VALIDO_DESDE",
               "VALIDO_HASTA", "USUARIO", "REGISTRATION_DATE"),
    output=(("TIPO_DOC", "string"), ("NRO_DOC", "string"), ("NOMBRE_CLIENTE", "string"),
            ("FECHA_NAC", "date"), ("TIPO_ENTIDAD", "string"), ("FECHA_REG", "timestamp_ntz"),
            ("FUENTE", "string"), ("NACIONALIDAD", "string"), ("RAMOS", "string"),
            ("COD_BROKER", "string"), ("BROKER", "string"), ("USUARIO", "string"),
            ("AGENCIAMIENTO", "string"), ("FECHA_DATA", "timestamp_ntz"), ("USUARIO_DATA", "string")),
    date_column="FECHA_REG",
    table="CLI.DATA_SD",
    preview=("TIPO_DOC", "NRO_DOC", "NOMBRE_CLIENTE", "FECHA_NAC", "TIPO_ENTIDAD", "FECHA_REG",
             "COD_BROKER", "BROKER"),
)

OS_SPEC = ReportSpec(
    name="OS",
    positions=(0, 1, 2, 3, 4, 5, 6, 7, 8, 9),
    raw_names=("ID", "TIPO_DOC", "NRO_DOC", "NOMBRE_CLIENTE", "FECHA_CREA", "FECHA_CARTA", "BROKER",
               "USUARIO_CREA", "USUARIO_CARTA", "ESTADO_CARTA"),
    output=(("ID", "int"), ("TIPO_DOC", "string"), ("NRO_DOC", "string"), ("NOMBRE_CLIENTE", "string"),
            ("FECHA_CREA", "date"), ("FECHA_CARTA", "date"), ("BROKER", "string"),
            ("USUARIO_CREA", "string"), ("USUARIO_CARTA", "string"), ("ESTADO_CARTA", "string"),
            ("FECHA_DATA", "timestamp_ntz"), ("USUARIO_DATA", "string")),
    date_column="FECHA_CREA",
    table="CLI.DATA_OS",
    preview=("ID", "TIPO_DOC", "NRO_DOC", "NOMBRE_CLIENTE", "FECHA_CREA", "BROKER"),
)

SPECS = {"SD": SD_SPEC, "OS": OS_SPEC}

# The cells of an SD row that realignment may move (TIPO_DOC and NRO_DOC never move).
SD_MOVABLE = SD_SPEC.raw_names[2:]
