"""Column names shared by every operator."""

DOCTOR = "doctor_id"
HOSPITAL = "hospital_id"
DOCTOR_RANK = "doctor_rank"
HOSPITAL_RANK = "hospital_rank"

EDGE_COLUMNS = (DOCTOR, HOSPITAL, DOCTOR_RANK, HOSPITAL_RANK)
