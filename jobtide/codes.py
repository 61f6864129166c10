"""Code tables of the data contract, and the ``Codebook`` that carries them.

Everything that decodes a code takes a ``Codebook``, so tables with other code
values can be bound without touching an operator.
"""

from __future__ import annotations

from dataclasses import dataclass, field

# The code tables below must equal the published data dictionary.
SEX = {"1": "Masculino", "3": "Feminino", "9": "Não identificado"}
RACE = {
    "1": "Branca",
    "2": "Preta",
    "3": "Parda",
    "6": "Amarela",
    "7": "Indígena",
    "9": "Não identificado",
}
SCHOOLING = {
    "1": "Analfabeto",
    "2": "Fundamental incompleto",
    "3": "Fundamental completo",
    "4": "Médio incompleto",
    "5": "Médio completo",
    "6": "Superior incompleto",
    "7": "Superior completo",
    "8": "Mestrado",
    "9": "Doutorado",
}
SECTOR = {
    "A": "Agropecuária",
    "B": "Indústria extrativa",
    "C": "Indústria de transformação",
    "D": "Energia e utilidades",
    "E": "Saneamento e gestão de resíduos",
    "F": "Construção civil",
    "G": "Comércio",
    "H": "Transporte e armazenagem",
    "I": "Alimentação e hospedagem",
    "J": "Informação e comunicação",
    "K": "Atividades financeiras",
    "L": "Atividades imobiliárias",
    "M": "Serviços profissionais",
    "N": "Serviços administrativos",
    "O": "Administração pública",
    "P": "Educação",
    "Q": "Saúde e assistência social",
    "R": "Artes e cultura",
    "S": "Outras atividades de serviços",
    "T": "Serviços domésticos",
    "U": "Organismos internacionais",
}
MOVEMENT = {1: "Admissão", -1: "Desligamento"}
REGION_CODE = {"Norte": 1, "Nordeste": 2, "Sudeste": 3, "Sul": 4, "Centro-Oeste": 5}
SEX_CODE = {"Masculino": 0, "Feminino": 1, "Não identificado": -1}
REGION_UFS = {
    "Norte": ["AC", "AM", "AP", "PA", "RO", "RR", "TO"],
    "Nordeste": ["AL", "BA", "CE", "MA", "PB", "PE", "PI", "RN", "SE"],
    "Sudeste": ["ES", "MG", "RJ", "SP"],
    "Sul": ["PR", "RS", "SC"],
    "Centro-Oeste": ["DF", "GO", "MS", "MT"],
}
SEASONS = ["Jan-Mar", "Abr-Jun", "Jul-Set", "Out-Dez"]
MONTHS = ["Jan", "Fev", "Mar", "Abr", "Mai", "Jun", "Jul", "Ago", "Set", "Out", "Nov", "Dez"]
NOT_IDENTIFIED = "Não identificado"
NOT_INFORMED = "Não informado"

# Historical phases as (years after the first, first month, last
# month, label), in chart order; any other date takes the last phase.
FINE_PHASES = [
    (0, 1, 6, "Pandemia aguda"),
    (0, 7, 12, "Pandemia inicial"),
    (1, 1, 12, "Pandemia tardia"),
    (2, 1, 12, "Recuperação"),
    (3, 1, 12, "Normalização"),
]
COARSE_PHASES = [
    (0, 1, 12, "Pandemia (2020)"),
    (1, 1, 12, "Pandemia tardia"),
    (2, 1, 12, "Recuperação"),
    (3, 1, 12, "Normalização"),
]
LAST_PHASE = "Expansão pós-pandemia"


def phase_order(phases: list[tuple]) -> list[str]:
    """Phase labels in chart order."""
    return [label for *_, label in phases] + [LAST_PHASE]


@dataclass(frozen=True)
class Codebook:
    """The code tables one run decodes with."""

    sex: dict = field(default_factory=lambda: SEX)
    race: dict = field(default_factory=lambda: RACE)
    schooling: dict = field(default_factory=lambda: SCHOOLING)
    sector: dict = field(default_factory=lambda: SECTOR)
    region_code: dict = field(default_factory=lambda: REGION_CODE)
    sex_code: dict = field(default_factory=lambda: SEX_CODE)
    region_ufs: dict = field(default_factory=lambda: REGION_UFS)
    valid_ufs: tuple = tuple(sorted(uf for ufs in REGION_UFS.values() for uf in ufs))
    first_year: int = 2020

    @property
    def schooling_code(self) -> dict:
        """Schooling labels numbered from 0 in their natural order."""
        return {label: rank for rank, label in enumerate(self.schooling.values())}


DEFAULT_CODEBOOK = Codebook()
