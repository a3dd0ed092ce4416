"""Legacy feed layouts ("schema versions") as data.

Everything the jobs need to know about a layout lives here: which source column
feeds which canonical field, the fingerprint used to recognise a feed from its
header, and the conventions used when writing a canonical row back out in the
layout (id prefix, date pattern, status vocabulary, missing-value token).

The jobs never branch on a layout in per-row Python; they read this registry at
plan-build time and emit one column expression per layout, or turn the registry
into a tiny literal DataFrame that is broadcast (its size is fixed: 8 layouts).
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession


#: Slot columns: the cells of a legacy record after binding a layout's columns.
SLOTS = ("raw_student_id", "raw_full_name", "raw_first_name", "raw_last_name", "raw_school_id",
         "raw_type", "raw_issue_date", "raw_status", "raw_preferred", "raw_updated_at")


@dataclass(frozen=True)
class Layout:
    version: str
    student_id: str
    school_id: str
    credential_type: str
    issue_date: str
    status: str
    updated_at: str
    full_name: str | None = None
    first_name: str | None = None
    last_name: str | None = None
    preferred_name: str | None = None
    columns: tuple[str, ...] = ()          # column order of a file written in this layout
    fingerprint: tuple[str, ...] = ()      # required columns that identify the layout
    id_prefix: str = ""
    date_pattern: str = "yyyy-MM-dd"       # Spark datetime pattern used on export
    status_vocab: tuple[str, str, str, str] = ("ACTIVE", "EXPIRED", "REVOKED", "PENDING")
    missing_token: str = ""
    position: int = field(default=0)       # registry order, used to break fingerprint ties

    @property
    def has_full_name(self) -> bool:
        return self.full_name is not None

    @property
    def has_preferred(self) -> bool:
        return self.preferred_name is not None

    def source_for(self, slot: str) -> str | None:
        """Source column bound to a canonical slot (``SLOTS``)."""
        return {
            "raw_student_id": self.student_id,
            "raw_full_name": self.full_name,
            "raw_first_name": self.first_name,
            "raw_last_name": self.last_name,
            "raw_school_id": self.school_id,
            "raw_type": self.credential_type,
            "raw_issue_date": self.issue_date,
            "raw_status": self.status,
            "raw_preferred": self.preferred_name,
            "raw_updated_at": self.updated_at,
        }[slot]


# ---------------------------------------------------------------------------
# FIXED VALUES — must equal the legacy system's layouts for correct results.
# Per layout: source column names for student id, name(s), school, credential
# type, issue date, status, preferred name, updated-at; the file column order;
# the fingerprint (required columns); and the export conventions (id prefix,
# date format, status words in the order ACTIVE, EXPIRED, REVOKED, PENDING,
# missing-value token).
# ---------------------------------------------------------------------------
_FIXED = [
    dict(version="v1", student_id="student_id", full_name="student_name", school_id="schoolId",
         credential_type="credentialType", issue_date="issueDate", status="status",
         preferred_name="preferred_name", updated_at="updated_at",
         columns=("student_id", "student_name", "schoolId", "credentialType", "issueDate", "status",
                  "preferred_name", "updated_at"),
         fingerprint=("student_id", "student_name", "schoolId", "credentialType", "issueDate", "status"),
         id_prefix="STU", date_pattern="yyyy-MM-dd'T'HH:mm:ss",
         status_vocab=("ACTIVE", "EXPIRED", "REVOKED", "PENDING"), missing_token=""),
    dict(version="v2", student_id="studentId", first_name="first_name", last_name="last_name",
         school_id="school_id", credential_type="cred_type", issue_date="issue_date",
         status="credentialStatus", preferred_name="preferredName", updated_at="last_modified",
         columns=("studentId", "first_name", "last_name", "school_id", "cred_type", "issue_date",
                  "credentialStatus", "preferredName", "last_modified"),
         fingerprint=("studentId", "first_name", "last_name", "school_id", "cred_type", "issue_date",
                      "credentialStatus"),
         id_prefix="S", date_pattern="MM/dd/yyyy",
         status_vocab=("Active", "Expired", "Revoked", "Pending"), missing_token="N/A"),
    dict(version="v3", student_id="stu_id", first_name="firstName", last_name="lastName",
         school_id="school_code", credential_type="credential_category", issue_date="issued_on",
         status="status_code", updated_at="modified_timestamp",
         columns=("stu_id", "firstName", "lastName", "school_code", "credential_category", "issued_on",
                  "status_code", "modified_timestamp"),
         fingerprint=("stu_id", "firstName", "lastName", "school_code", "credential_category", "issued_on",
                      "status_code"),
         id_prefix="stu", date_pattern="yyyy-MM-dd",
         status_vocab=("ACT", "EXP", "REV", "PND"), missing_token=""),
    dict(version="v4", student_id="learner_id", first_name="given_name", last_name="family_name",
         school_id="institution_id", credential_type="type_cd", issue_date="date_issued",
         status="cred_status", preferred_name="pref_name", updated_at="last_updated",
         columns=("learner_id", "given_name", "family_name", "institution_id", "type_cd", "date_issued",
                  "cred_status", "pref_name", "last_updated"),
         fingerprint=("learner_id", "given_name", "family_name", "institution_id", "type_cd", "date_issued",
                      "cred_status"),
         id_prefix="LRN", date_pattern="yyyy-MM-dd",
         status_vocab=("A", "E", "R", "P"), missing_token="UNKNOWN"),
    dict(version="v5", student_id="student_id", full_name="student_name", school_id="school_ref",
         credential_type="credential_type", issue_date="issue_dt", status="status", updated_at="updated_at",
         columns=("student_id", "student_name", "school_ref", "credential_type", "issue_dt", "status",
                  "updated_at"),
         fingerprint=("student_id", "student_name", "school_ref", "credential_type", "issue_dt", "status"),
         id_prefix="STU", date_pattern="dd-MMM-yyyy",
         status_vocab=("ACTIVE", "EXPIRED", "REVOKED", "PENDING"), missing_token=""),
    dict(version="v6", student_id="id", first_name="name_first", last_name="name_last", school_id="schl_id",
         credential_type="credType", issue_date="issuedDate", status="state", updated_at="modified",
         columns=("id", "name_first", "name_last", "schl_id", "credType", "issuedDate", "state", "modified"),
         fingerprint=("id", "name_first", "name_last", "schl_id", "credType", "issuedDate", "state"),
         id_prefix="", date_pattern="yyyy-MM-dd'T'HH:mm:ss'Z'",
         status_vocab=("active", "expired", "revoked", "pending"), missing_token="null"),
    dict(version="v7", student_id="student_number", first_name="first_name", last_name="last_name",
         school_id="school_number", credential_type="cert_type", issue_date="cert_date", status="cert_status",
         preferred_name="preferred_name", updated_at="record_updated",
         columns=("student_number", "first_name", "last_name", "school_number", "cert_type", "cert_date",
                  "cert_status", "preferred_name", "record_updated"),
         fingerprint=("student_number", "first_name", "last_name", "school_number", "cert_type", "cert_date",
                      "cert_status"),
         id_prefix="SN", date_pattern="MM-dd-yyyy",
         status_vocab=("Active", "Expired", "Revoked", "Pending"), missing_token=""),
    dict(version="v8", student_id="student_uid", full_name="full_name", school_id="school_id",
         credential_type="qualification_type", issue_date="issue_date", status="credential_state",
         preferred_name="preferred_name", updated_at="updated_at",
         columns=("student_uid", "full_name", "school_id", "qualification_type", "issue_date",
                  "credential_state", "preferred_name", "updated_at"),
         fingerprint=("student_uid", "full_name", "school_id", "qualification_type", "issue_date",
                      "credential_state"),
         id_prefix="UID", date_pattern="yyyy-MM-dd",
         status_vocab=("ISSUED", "EXPIRED", "REVOKED", "DRAFT"), missing_token="N/A"),
]

LAYOUTS: dict[str, Layout] = {d["version"]: Layout(position=i, **d) for i, d in enumerate(_FIXED)}
VERSIONS: tuple[str, ...] = tuple(LAYOUTS)
FULL_NAME_VERSIONS: tuple[str, ...] = tuple(v for v, l in LAYOUTS.items() if l.has_full_name)
PREFERRED_VERSIONS: tuple[str, ...] = tuple(v for v, l in LAYOUTS.items() if l.has_preferred)


def layout(version: str) -> Layout:
    try:
        return LAYOUTS[version]
    except KeyError:
        raise KeyError(f"unknown layout {version!r}; known: {', '.join(VERSIONS)}") from None


def detection_order(layouts: dict[str, Layout] = LAYOUTS) -> list[Layout]:
    """Layouts in the order a multi-match is resolved: larger fingerprint
    first, registry order among equals."""
    return sorted(layouts.values(), key=lambda l: (-len(l.fingerprint), l.position))


def fingerprints_df(spark: SparkSession, layouts: dict[str, Layout] = LAYOUTS) -> DataFrame:
    """Long form (version, column, flag, fp_size, position) — 54 rows, fixed;
    ``flag`` is the column's bit in its layout's fingerprint mask."""
    rows = [
        (l.version, c, 1 << i, len(l.fingerprint), l.position)
        for l in layouts.values()
        for i, c in enumerate(l.fingerprint)
    ]
    return spark.createDataFrame(rows, "version string, column string, flag int, fp_size int, position int")
