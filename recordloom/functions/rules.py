"""Pattern sets that classify titles and texts, and the columns that apply them.

Patterns are Java's; (?U) makes \\b and \\s aware of all letters, as in the
texts' own language. A set is data: an operator takes any mapping of codes to
patterns, so other rules serve other tables.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

_I = "(?iU)"
#: Roles by the beginning of a title, first match first.
ROLES = {
    "concern": _I + r"^(?:(?:editorial\s+)?expression\s+of\s+concern|retraction(?:\s+note)?|retracted|withdrawal|withdrawn)\b",
    "correction": _I + r"^(?:(?:author|publisher)\s+)?correction\b|^corrigendum\b|^erratum\b",
    "editorial": _I + r"^(?:(?:guest\s+)?editorial(?:\s*:|\s*$)|preface\b|introduction\s+(?:to|for)\s+(?:the\s+)?(?:special|themed)\s+issue\b)",
}
#: Fixed value: how correspondence begins.
CORRESPONDENCE = _I + r"^\s*(?:re\s*:|comment(?:ary)?\s+(?:on|regarding)\b|reply\b|response\s+to\b|author\s+response\b|letter\s+to\b|concerns?\s+about\b)"
#: Structural paths of titles.
PATHS = {
    "GUIDANCE": _I + r"^\s*(?:clinical\s+practice\s+|practice\s+|reporting\s+|management\s+|treatment\s+|diagnostic\s+)?guidelines?\b|:\s*(?:an?\s+)?(?:[A-Za-z0-9-]+\s+){0,4}guidelines?\b|\b(?:position|consensus)\s+statement\b|\bexpert\s+consensus\s+(?:recommendations?|guidelines?|report|statement)\b",
    "EVIDENCE_SYNTHESIS": _I + r"\bsystematic review\b|\bmeta[- ]analysis\b|\bumbrella review\b|\bscoping review\b|\bnetwork meta[- ]analysis\b",
    "RANDOMIZED_TRIAL": _I + r"(?<!non-)(?<!non )\brandomi[sz]ed(?: controlled| clinical)? trial\b|(?<!non-)(?<!non )\bcluster[- ]randomi[sz]ed\b|\brandomly assigned\b",
    "REPLICATION_VALIDATION": _I + r"\breplication (?:study|attempt|analysis|experiment|report)\b|\breproducibility(?: study| analysis| assessment| evaluation)?\b|\bexternal validation\b|\bindependent validation\b|\bmulticent(?:re|er) validation\b|\bvalidation study\b",
    "SAFETY_SIGNAL": _I + r"\b(?:drug|treatment|clinical|patient|model|system|vaccine|device|surgical|medication) safety\b|\badverse (?:event|effect|outcome|reaction)s?\b|\btoxicit(?:y|ies)\b|\bself-harm\b|\bmortality\b",
    "RESOURCE_BENCHMARK": _I + r"\bbenchmark(?:ing)?\b|\b(?:new|novel|open|public|large-scale|multimodal|curated|reference|synthetic|clinical)\s+(?:benchmark\s+)?dataset\b|\bdataset\s+(?:for|of|to|with|containing)\b|\bcorpus\b|\bopen database\b|\breference database\b|\bdata resource\b",
    "PROSPECTIVE_LONGITUDINAL": _I + r"\bprospective\b|\blongitudinal\s+(?:study|analysis|cohort|data|follow-up|survey)\b",
    "OBSERVATIONAL_DESIGN": _I + r"\bretrospective\b|\bcase-control\b|\bcross[- ]sectional\b|\b(?:population-based\s+|register-based\s+|nationwide\s+)?cohort\s+(?:study|analysis|follow-up)\b",
    "SURVEY": _I + r"\bsurvey\b",
    "PROTOCOL": _I + r"\b(?:study |trial )?protocol(?:\s+for|\s*:|\s*$)|^\s*protocol\b",
    "CASE_REPORT": _I + r"\bcase report\b|\bcase series\b",
}
#: Signals of abstracts.
ABSTRACT_SIGNALS = {
    "METHODS_SECTION": _I + r"(?:^|\n|\b)(?:methods?|methodology|materials and methods?)\s*[:.\-]",
    "RESULTS_SECTION": _I + r"(?:^|\n|\b)(?:results?|findings?)\s*[:.\-]",
    "SAMPLE_SIZE": _I + r"(?:\bn\s*=\s*\d{2,}\b|\b(?:included|enrolled|randomi[sz]ed|participants?|patients?|subjects?|samples?)\s+(?:were\s+)?\d{2,}\b|\b\d{2,}\s+(?:participants?|patients?|subjects?|samples?)\b)",
    "EFFECT_ESTIMATE": _I + r"(?:95\s*%\s*CI|confidence interval|hazard ratio|odds ratio|risk ratio|relative risk|mean difference|\bSMD\b|\bHR\s*[=:]|\bOR\s*[=:]|\bRR\s*[=:]|\bp\s*[<=>]\s*0?\.\d+)",
    "REGISTRATION": _I + r"(?:clinicaltrials\.gov|trial registration|registered at|prospero|preregister|pre-registr)",
    "MULTICENTER_OR_EXTERNAL_VALIDATION": _I + r"(?:multi[- ]?cent(?:er|re)|multi[- ]?site|external validation|independent validation|held[- ]?out (?:cohort|dataset|test set))",
    "LIMITATIONS": _I + r"\blimitations?\b",
    "DATA_OR_CODE_AVAILABILITY": _I + r"(?:data availability|code (?:is|are) available|github\.com|open source|publicly available dataset)",
}
#: Fixed value: how an abstract states a result.
RESULT_SIGNAL = _I + r"(?:\bresults?\b|\bfindings?\b|\bwe found\b|\bwas associated\b|\bwere associated\b|\bsignificantly\b|95\s*%\s*CI|\bp\s*[<=>]\s*0?\.\d+)"
#: What a full text reports.
REPORTING_SIGNALS = {
    "RANDOMIZATION": _I + r"\brandomi[sz](?:ed|ation|ing)\b|random allocation|random sequence",
    "SAMPLE_SIZE": _I + r"(?:\bn\s*=\s*\d{2,}\b|\b\d{2,}\s+(?:participants?|patients?|subjects?|samples?|cases?|controls?)\b|(?:included|enrolled|analysed|analyzed|randomi[sz]ed)\s+\d{2,})",
    "PRIMARY_OUTCOME": _I + r"\bprimary (?:outcome|endpoint)\b|prespecified (?:outcome|endpoint)",
    "EFFECT_ESTIMATE": _I + r"(?:95\s*%\s*CI|confidence interval|hazard ratio|odds ratio|risk ratio|relative risk|mean difference|standardized mean difference|\bSMD\b|\bHR\s*[=:]|\bOR\s*[=:]|\bRR\s*[=:])",
    "REGISTRATION": _I + r"(?:clinicaltrials\.gov|trial registration|registered at|prospero|preregister|pre-registr|registration number)",
    "ALLOCATION_CONCEALMENT": _I + r"(?:allocation conceal|concealed allocation|sealed opaque|central randomi[sz]ation)",
    "MASKING": _I + r"\b(?:double|single|triple)[ -]?(?:blind|masked)\b|\bblinded\b|\bmasked\b",
    "INTENTION_TO_TREAT": _I + r"intention[- ]to[- ]treat|intent[- ]to[- ]treat|modified intention[- ]to[- ]treat|\bITT\b",
    "ATTRITION_OR_MISSING": _I + r"(?:lost to follow[- ]?up|dropout|withdrawal|missing data|multiple imputation|complete case)",
    "SEARCH_STRATEGY": _I + r"(?:search strategy|searched (?:medline|pubmed|embase|scopus|web of science|cinahl)|electronic databases|database search)",
    "RISK_OF_BIAS_METHOD": _I + r"(?:risk of bias|rob 2|robins[- ]?i|newcastle[- ]ottawa|quality assessment)",
    "HETEROGENEITY": _I + r"(?:heterogeneity|\bI\s*[²2]\s*[=:]|tau[- ]?squared|random[- ]effects model)",
    "FOLLOW_UP": _I + r"(?:follow[- ]?up|followed for|median follow[- ]?up|years? of follow[- ]?up)",
    "CONFOUNDING_ADJUSTMENT": _I + r"(?:adjusted for|multivariable|multivariate|propensity score|inverse probability weight|covariate adjustment|confounder)",
    "EXTERNAL_VALIDATION": _I + r"(?:external validation|independent validation|validation cohort|held[- ]out (?:cohort|dataset|test set)|replication cohort)",
    "DATA_OR_CODE_AVAILABILITY": _I + r"(?:data availability|code availability|github\.com|code is available|data are available|publicly available dataset|open[- ]source code)",
    "LIMITATIONS": _I + r"\blimitations?\b|strengths and limitations",
    "FUNDING": _I + r"\bfunding\b|financial support|grant support",
    "CONFLICT_OF_INTEREST": _I + r"(?:conflict(?:s)? of interest|competing interests|declaration of interests|financial disclosure)",
    "RECOMMENDATION_LANGUAGE": _I + r"(?:we recommend|recommendation|should be offered|should receive|guideline recommends?)",
}


def matched(text: Column, rules: Mapping[str, str]) -> Column:
    """Array of the codes whose pattern occurs, in the rules' order."""
    return F.array_compact(F.array(*(F.when(text.rlike(p), F.lit(code)) for code, p in rules.items())))


def first_match(text: Column, rules: Mapping[str, str], default: str) -> Column:
    """The first code whose pattern occurs; later patterns aren't tried."""
    chain = None
    for code, pattern in rules.items():
        chain = (F if chain is None else chain).when(text.rlike(pattern), code)
    return chain.otherwise(default)


def weights(table: Mapping[str, float]) -> Column:
    """A map column of a small table."""
    return F.create_map(*(x for k, v in table.items() for x in (F.lit(k), F.lit(v))))


def weighted_sum(codes: Column, table: Mapping[str, float]) -> Column:
    w = weights(table)
    zero = F.lit(0) if all(isinstance(v, int) for v in table.values()) else F.lit(0.0)
    return F.aggregate(codes, zero, lambda acc, c: acc + F.coalesce(F.try_element_at(w, c), zero))
