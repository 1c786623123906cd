"""Ad-click streams on Structured Streaming."""
