"""DataFrame to DataFrame operators: precombine, merge, conform, quarantine, transform."""
