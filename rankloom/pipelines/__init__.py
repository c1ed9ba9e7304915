"""The jobs that users run: operators composed into whole updates."""
