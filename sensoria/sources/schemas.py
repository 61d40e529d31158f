"""Bronze schemas of the landed files."""

from __future__ import annotations

# Columns that are always doubles, whatever a file's values look like.
TRAFFIC_TYPES = {
    "intensidad": "double",
    "ocupacion": "double",
    "carga": "double",
    "vmed": "double",
}

TRAFFIC = (
    "id bigint, fecha timestamp_ntz, tipo_elem string, intensidad double, "
    "ocupacion double, carga double, vmed double, error string, "
    "periodo_integracion int"
)

TRAFFIC_POINTS = (
    "tipo_elem string, distrito string, id bigint, cod_cent string, nombre string, "
    "utm_x double, utm_y double, longitud double, latitud double"
)

AIR = (
    "PROVINCIA int, MUNICIPIO int, ESTACION bigint, MAGNITUD int, PUNTO_MUESTREO string, "
    "ANO int, MES int, "
    + ", ".join(f"D{day:02d} double, V{day:02d} string" for day in range(1, 32))
)
