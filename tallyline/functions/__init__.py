"""Column expressions shared by the operators; nothing here starts a job."""
