"""DataFrame to DataFrame operators over files, chunks, versions, changes, schedules and audit rows."""
