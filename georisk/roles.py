"""Which column plays which part.

Every operator takes its column names from a ``Roles`` value, so the same code
runs on the yearly occurrence files (the defaults) and on any other table that
has a time, a place, four measures and a target.
"""

from __future__ import annotations

from dataclasses import dataclass


# Column names of the occurrence, metric and forecast files.
@dataclass(frozen=True)
class Roles:
    time: str = "DataHora"
    date: str = "Data"
    region: str = "Estado"
    locality: str = "Municipio"
    lat: str = "Latitude"
    lon: str = "Longitude"
    dry_days: str = "DiaSemChuva"
    precip: str = "Precipitacao"
    frp: str = "FRP"
    risk: str = "RiscoFogo"
    year: str = "Ano"
    month: str = "Mes"
    day_of_year: str = "DiaAno"
    month_flag: str = "Mes_"
    encoded: str = "_encoded"
    prediction: str = "Risco_pred"
    cluster: str = "Cluster"
    frequency: str = "Frequencia"
    unused: tuple[str, ...] = ("Satelite", "Pais", "Bioma")
    source: str = "source_file"

    @property
    def measures(self) -> tuple[str, ...]:
        return (self.dry_days, self.precip, self.frp, self.risk)

    @property
    def place(self) -> tuple[str, ...]:
        return (self.lat, self.lon, self.region, self.locality)

    @property
    def numeric(self) -> tuple[str, ...]:
        return (*self.measures, self.lat, self.lon)

    @property
    def categories(self) -> tuple[str, ...]:
        return (self.region, self.locality)

    @property
    def month_flags(self) -> tuple[str, ...]:
        return tuple(f"{self.month_flag}{m}" for m in range(1, 13))

    @property
    def forecast(self) -> tuple[str, ...]:
        """Columns of the forecast file, in file order."""
        return (
            self.date, self.region, self.locality, self.risk, self.dry_days,
            self.precip, self.frp, self.lat, self.lon,
        )


DEFAULT_ROLES = Roles()
