"""What a source delivers and how one ingest of it is described."""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import date

from pyspark.sql import DataFrame

from longhouse import schemas as S

RAW_INGEST = "Ingest raw de-identified data"


@dataclass(frozen=True)
class CsvFormat:
    """Delimiter, quote, date pattern and decimal mark of a delivery."""

    delim: str = ","
    quote: str = '"'
    date_format: str = "yyyy-MM-dd"
    decimal: str = "."
    multiline: bool = True  # cells in quotes may hold line breaks


@dataclass(frozen=True)
class SourceConfig:
    """A study: its sites, protocols, instruments and ethics approvals.

    ``country_col`` empty means that ``country_name`` holds for every site. ``ethics`` maps a file
    to its name, committee and the protocol it approves.
    """

    name: str
    site_data: str
    site_col: str
    country_col: str = ""
    country_name: str = ""
    study_type_id: int = 1
    datafolder: str = "De_identified_data"
    protocolfolder: str = "Protocols"
    protocols: dict[str, str] = field(default_factory=dict)
    instrumentfolder: str = "Instruments"
    instruments: dict[str, str] = field(default_factory=dict)
    ethicsfolder: str = "Ethics"
    ethics: dict[str, tuple[str, str, str]] = field(default_factory=dict)
    csv: CsvFormat = CsvFormat()


@dataclass(frozen=True)
class IngestConfig:
    """One ingest of a source: its domain, death file, datasets and dictionaries.

    ``datasets`` maps a description to a file. ``as_of`` is the date stamped on new rows, today if
    it is not given.
    """

    source: SourceConfig
    id_col: str
    domain_name: str
    death_file: str
    datasets: dict[str, str]
    datadictionaries: list[str]
    domain_description: str = ""
    ingest_desc: str = RAW_INGEST
    transform_desc: str = RAW_INGEST
    code_reference: bytes = b""
    author: str = ""
    unit_of_analysis_id: int = S.UNIT_INDIVIDUAL
    transformation_type_id: int = S.TRANSFORMATION_INGEST
    transformation_status_id: int = S.STATUS_VERIFIED
    as_of: date | None = None
    csv: CsvFormat = CsvFormat()


@dataclass(frozen=True)
class UserIngestConfig:
    """Datasets a user derived from stored ones (operator I-6).

    ``datasets`` maps a name to a frame, ``input_datasets`` the same name to the dataset ids it was
    made from.
    """

    id_col: str
    domain_name: str
    datasets: dict[str, DataFrame]
    input_datasets: dict[str, list[int]]
    datadictionaries: dict[str, str] = field(default_factory=dict)
    domain_description: str = ""
    source_name: str = "user"
    ingest_desc: str = "Derived datasets"
    transform_desc: str = "Description of data processing methodology."
    code_reference: bytes = b""
    author: str = ""
    unit_of_analysis_id: int = S.UNIT_AGGREGATION
    transformation_type_id: int = S.TRANSFORMATION_TRANSFORM
    transformation_status_id: int = S.STATUS_UNVERIFIED
    as_of: date | None = None


# Month name, day and year as two of the studies write dates.
MONTH_NAME_DATES = CsvFormat(date_format="MMM d, yyyy")

# The studies the archive is set up for.


def champs_source() -> SourceConfig:
    return SourceConfig(
        name="CHAMPS",
        site_data="CHAMPS_deid_basic_demographics.csv",
        site_col="site_iso_code",
        country_col="site_iso_code",
        protocols={
            "CHAMPS-Mortality-Surveillance-Protocol-v1.3.pdf": "CHAMPS Mortality Surveillance Protocol",
            "CHAMPS-Social-Behavioral-Science-Protocol-v1.0.pdf": "CHAMPS Social Behavioral Science Protocol",
            "CHAMPS-Diagnosis-Standards.pdf": "CHAMPS DeCoDe Diagnosis Standards",
            "CHAMPS-Manual-v3.pdf": "CHAMPS Manual",
            "CHAMPS Online De-Identified DTA.pdf": "CHAMPS Online De-Identified Data Transfer Agreement",
        },
        instruments={"cdc_93759_DS9.pdf": "CHAMPS_deid_verbal_autopsy.csv"},
        ethics={
            "ICF-04 CHAMPS VA v1.1.pdf": (
                "ICF-04 CHAMPS VA v1.1",
                "Local ethics institution",
                "CHAMPS-Mortality-Surveillance-Protocol-v1.3.pdf",
            ),
            "ICF-03_CHAMPS non_MITS consent v1.3.pdf": (
                "ICF-03_CHAMPS non_MITS consent v1.3",
                "Local ethics institution",
                "CHAMPS-Mortality-Surveillance-Protocol-v1.3.pdf",
            ),
            "ICF-01 CHAMPS MITS procedures v1.3.pdf": (
                "ICF-01 CHAMPS MITS procedures v1.3",
                "Local ethics institution",
                "CHAMPS-Mortality-Surveillance-Protocol-v1.3.pdf",
            ),
        },
    )


def comsa_mozambique_source() -> SourceConfig:
    protocol = "COMSA-protocol_without-FR_version-1.1_15June2017_clean_REVISED.pdf"
    committee = "National Health Bioethics Committee of Mozambique"
    data = "Comsa_WHO_VA_20230308.csv"
    program = "Countrywide Mortality Surveillance for Action (COMSA) Mozambique"
    return SourceConfig(
        name="COMSAMZ",
        site_data=data,
        site_col="provincia",
        country_name="Mozambique",
        protocols={
            "COMSA-FR-protocol_version-1.0_05July2017.pdf": f"{program} (Formative Research)",
            protocol: program,
            "COMSA-Data-Access-Plan.pdf": "COMSA Data Access Plan",
            "Data Use Agreement (DUA) - Comsa.pdf": "COMSA Data Use Agreement",
        },
        instruments={
            "5a_2018_COMSA_VASA_ADULTS-EnglishOnly_01262019_clean.pdf": data,
            "5a_2018_COMSA_VASA_CHILD-EnglishOnly_12152018Clean.pdf": data,
            "5a_2018_COMSA_VASA_SB_NN-EnglishOnly_12152018Clean.pdf": data,
            "5a_2018_COMSA_VASA-GenInfo_English_06272018_clean.pdf": data,
        },
        ethics={
            "adult vasa - version 1, 2020 07 15.docx": (
                "adult vasa - version 1", committee, protocol,
            ),
            "child assent vasa - version 1, 2020 07 15.docx": (
                "child assent vasa - version 1", committee, protocol,
            ),
        },
        csv=MONTH_NAME_DATES,
    )


def heal_sierra_leone_source() -> SourceConfig:
    protocol = "4_COMSA Protocol - 27-Feb-2022.pdf"
    data = "healsl_all_v1.csv"
    return SourceConfig(
        name="HEALSL",
        site_data=data,
        site_col="id10057",
        country_name="Sierra Leone",
        protocols={
            protocol: "HEAL-SL (COMSA Sierra Leone) Protocol",
            "HEAL-SL Research Data Processing Notes for Extenal.pdf": "HEAL-SL Data Processing Notes",
        },
        instruments={
            "Adult_eVA_Questionnaire-SL.pdf": data,
            "Child_eVA_Questionnaire-SL.pdf": data,
            "Neonate_eVA_Questionnaire-SL.pdf": data,
        },
        ethics={
            "IRB Renewed.pdf": ("IRB Renewed", "Government of Sierra Leone", protocol),
            "Annexe 2 Consent forms- 27-Feb-2022.pdf": (
                "Consent forms", "Government of Sierra Leone", protocol,
            ),
        },
        csv=MONTH_NAME_DATES,
    )


def champs_ingest() -> IngestConfig:
    return IngestConfig(
        source=champs_source(),
        id_col="champs_deid",
        domain_name="CHAMPS",
        domain_description="Raw CHAMPS level-2 deidentified data",
        death_file="CHAMPS_deid_basic_demographics.csv",
        # The files of the delivery.
        datasets={
            "CHAMPS deid basic demographics": "CHAMPS_deid_basic_demographics.csv",
            "CHAMPS deid verbal autopsy": "CHAMPS_deid_verbal_autopsy.csv",
            "CHAMPS deid decode results": "CHAMPS_deid_decode_results.csv",
            "CHAMPS deid tac results": "CHAMPS_deid_tac_results.csv",
            "CHAMPS deid lab results": "CHAMPS_deid_lab_results.csv",
        },
        datadictionaries=[
            "CHAMPS_deid_basic_demographics_dictionary.xlsx",
            "CHAMPS_deid_decode_results_dictionary.xlsx",
            "CHAMPS_deid_tac_results_dictionary.xlsx",
            "CHAMPS_deid_lab_results_dictionary.xlsx",
            "CHAMPS_deid_verbal_autopsy_dictionary.xlsx",
        ],
        ingest_desc="Raw CHAMPS level-2 Data accessed 20230518",
        transform_desc="Ingest of CHAMPS Level-2 Data",
    )


def comsa_mozambique_ingest() -> IngestConfig:
    data = "Comsa_WHO_VA_20230308.csv"
    return IngestConfig(
        source=comsa_mozambique_source(),
        id_col="comsa_id",
        domain_name="COMSAMZ",
        domain_description="Raw COMSA Mozambique level-2 deidentified data",
        death_file=data,
        datasets={"COMSA Mozambique deid verbal autopsy": data},
        datadictionaries=[
            "Comsa_WHO_VA_20230308_dictionary.xlsx", "Comsa_death_20230308_dictionary.xlsx",
        ],
        ingest_desc="Raw COMSA Mozambique level-2 Data accessed 20230518",
        transform_desc="Ingest of COMSA MZ Level-2 Data",
        csv=MONTH_NAME_DATES,
    )


def heal_sierra_leone_ingest() -> IngestConfig:
    data = "healsl_all_v1.csv"
    return IngestConfig(
        source=heal_sierra_leone_source(),
        id_col="rowid",
        domain_name="HEALSL",
        domain_description="Raw HEAL Sierra Leone level-2 deidentified data",
        death_file=data,
        datasets={"HEALSL deid verbal autopsy": data},
        datadictionaries=["healsl_all_v1_dictionary.xlsx"],
        ingest_desc="Raw HEALSL level-2 Data accessed 20230518",
        transform_desc="Ingest of HEALSL Level-2 Data",
        csv=MONTH_NAME_DATES,
    )
