"""DataFrame -> DataFrame operators: identification, survivors, screens, reports, scoring."""
