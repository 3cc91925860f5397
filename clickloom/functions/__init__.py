"""Column expressions and schema helpers; nothing here shuffles or runs a job."""
