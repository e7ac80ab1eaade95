from .averaging import (ensemble_average, equal_weights, min_models, normalise_forecasts,
                        weighted_mean, weighted_median)
from .criteria import ensemble_criteria
from .pairwise import pair_changes, relative_skill
from .scoring import point_to_median, score_forecasts
from .skill import relative_skill_ensemble, skill_weights, update_inclusion
from .submission import add_point_forecasts, format_ensemble
from .summary import continuous_weeks, evaluation_table, summarise_scores
from .truth import add_status, attach_truth, convert_to_weekly
