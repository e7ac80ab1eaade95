from .submissions import start_intake, submission_stream

__all__ = ["start_intake", "submission_stream"]
