"""Column expressions shared by every job. All of them stay inside Catalyst."""
