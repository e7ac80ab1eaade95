from . import hubdata
from .files import (parse_target, preview_links, read_designations, read_evaluation,
                    read_status, read_submissions, window_dates)
