"""The school registry as configuration: contracts, check rules, arrival rules.

Field names, ranges and limits are fixed values of the domain.
"""

from __future__ import annotations

from jsonloom.operators.arrival import ArrivalReference, ArrivalRules
from jsonloom.operators.contracts import Contract, Field
from jsonloom.operators.quality.capacity import CapacityRule, EntityLimit
from jsonloom.operators.quality.consistency import FieldRule
from jsonloom.operators.quality.integrity import Reference
from jsonloom.operators.quality.suite import Rules

STUDENTS = Contract(
    "students",
    "student_id",
    (
        Field("student_id"), Field("first_name"), Field("last_name"),
        Field("age", "int", low=5, high=25), Field("gender"),
        Field("year", "int", low=1, high=12), Field("gpa", "double", low=0.0, high=4.0),
        Field("address", required=False), Field("email", required=False), Field("phone", required=False),
        Field("enrollment_date", required=False),
    ),
)
TEACHERS = Contract(
    "teachers",
    "teacher_id",
    (
        Field("teacher_id"), Field("first_name"), Field("last_name"), Field("department"), Field("email"),
        Field("hire_date", required=False), Field("salary", "double", required=False),
        Field("office_number", required=False), Field("phone", required=False),
        Field("qualifications", "array<string>", required=False),
    ),
)
CLASSES = Contract(
    "classes",
    "class_id",
    (
        Field("class_id"), Field("class_name"), Field("room_number"), Field("teacher_id"), Field("schedule"),
        Field("semester"), Field("max_capacity", "int"), Field("current_enrollment", "int"),
    ),
    {"enrollment within capacity": "current_enrollment <= max_capacity"},
)
STUDENT_CLASSES = Contract(
    "student_classes",
    "student_class_id",
    (
        Field("student_class_id"), Field("student_id"), Field("class_id"),
        Field("grade", required=False), Field("enrollment_date", required=False),
    ),
)
CONTRACTS = [STUDENTS, TEACHERS, CLASSES, STUDENT_CLASSES]

MAX_ENROLLMENTS_CHECKED = 8
MAX_ENROLLMENTS_ADMITTED = 5
UTILIZATION = 0.8

# (parent, key, child, child key, column) of the recount
RECOUNT = ("classes", "class_id", "student_classes", "class_id", "current_enrollment")

# kind -> (prefix, first number) of generated ids
ID_STARTS = {"student": ("S", 1000), "teacher": ("T", 100), "class": ("C", 2000), "student_class": ("SC", 5000)}

CAPACITIES = [CapacityRule("classes", "class_id", "max_capacity", "student_classes", "class_id")]
LIMITS = [EntityLimit("student_classes", "student_id", MAX_ENROLLMENTS_CHECKED)]
FIELD_RULES = [FieldRule("students", ("age", "year"), "(age < 14 and year > 9) or (age > 19 and year < 12)")]


def contract_rules() -> Rules:
    """References and keys of the fixed schemas."""
    references = [Reference(r.child, r.foreign_key, r.parent) for r in ARRIVAL.references]
    return Rules(references, {c.table: c.key for c in CONTRACTS})


def with_school_rules(rules: Rules) -> Rules:
    """Rules of a discovered catalog plus the school's own."""
    return Rules(rules.references, rules.primary_keys, CAPACITIES, LIMITS, FIELD_RULES, rules.extra)


ARRIVAL = ArrivalRules(
    keys={"teachers": "teacher_id", "students": "student_id", "classes": "class_id"},
    references=(
        ArrivalReference("class_teacher", "classes", "teacher_id", "teachers", "teacher_id", "class_id"),
        ArrivalReference("enrollment_student", "student_classes", "student_id", "students", "student_id", "student_class_id"),
        ArrivalReference("enrollment_class", "student_classes", "class_id", "classes", "class_id", "student_class_id"),
    ),
    capacity=("classes", "class_id", "max_capacity", "student_classes", "class_id"),
)
