"""Values the SQL twins expect, stated here again so that a wrong one in the engine shows up."""

from __future__ import annotations

# --- fixed values ----------------------------------------------------------------------------
SEVERITIES = ['INFO', 'LOW', 'MEDIUM', 'HIGH', 'CRITICAL']
SEVERITIES_DESC = SEVERITIES[::-1]
GENERIC_WORDS = {'critical': 'CRITICAL',
 'high': 'HIGH',
 'medium': 'MEDIUM',
 'low': 'LOW',
 'info': 'INFO',
 'informational': 'INFO',
 'warning': 'MEDIUM',
 'error': 'HIGH'}
BANDIT_WORDS = {'high': 'HIGH', 'medium': 'MEDIUM', 'low': 'LOW'}
PYLINT_WORDS = {'fatal': 'CRITICAL', 'error': 'HIGH', 'warning': 'MEDIUM', 'refactor': 'LOW', 'convention': 'INFO'}
SNYK_WORDS = {'critical': 'CRITICAL', 'high': 'HIGH', 'medium': 'MEDIUM', 'low': 'LOW'}
CHECK_NAME_WORDS = {'CRITICAL': ['public', 'exposed', 'secret', 'password', 'credential', '0.0.0.0/0', 'open to internet',
              'publicly accessible'],
 'HIGH': ['encryption', 'kms', 'ssl', 'tls', 'https', 'iam', 'policy', 'permission', 'wildcard', 'mfa',
          'root account', 'admin'],
 'MEDIUM': ['logging', 'log', 'monitoring', 'cloudtrail', 'cloudwatch', 'versioning', 'backup', 'retention',
            'audit'],
 'LOW': ['tag', 'name', 'description', 'metadata']}
EMOJI = {'CRITICAL': ':red_circle:', 'HIGH': ':orange_circle:', 'MEDIUM': ':yellow_circle:', 'LOW': ':white_circle:'}
SARIF_LEVELS = {'CRITICAL': 'error', 'HIGH': 'error', 'MEDIUM': 'warning', 'LOW': 'note', 'INFO': 'note'}
SARIF_SCORES = {'CRITICAL': '9.0', 'HIGH': '7.0', 'MEDIUM': '5.0', 'LOW': '3.0', 'INFO': '1.0'}
NOT_TEMPLATE_PATHS = ['package.json', 'package-lock.json', 'tsconfig.json', 'manifest.json', '.eslintrc.json', 'jest.config.json',
 'node_modules', '.git', 'test', 'spec']
SECRET_PATTERNS = {'aws-access-key-id': '\\b(AKIA|ASIA)[0-9A-Z]{16}\\b',
 'private-key': '-----BEGIN [A-Z ]*PRIVATE KEY-----',
 'github-token': '\\bgh[pousr]_[0-9A-Za-z]{36}\\b',
 'slack-token': '\\bxox[baprs]-[0-9A-Za-z-]{10,48}',
 'jwt': '\\beyJ[0-9A-Za-z_-]{10,}\\.eyJ[0-9A-Za-z_-]{10,}\\.[0-9A-Za-z_-]{10,}',
 'hex-token': '(?i)\\b(token|secret|api_key|password)\\s*[=:]\\s*\\"[0-9a-f]{32,64}\\"',
 'generic-api-key': '(?i)\\bapi[_-]?key\\s*[=:]\\s*[\\"\']?[0-9a-z]{16,64}'}
EXCLUDED_PATHS = ['.git', 'node_modules', '.terraform', 'venv', '__pycache__', '*.pyc', 'tests', 'test', '**/fixtures']
EXCLUDED_RULES = {'terraform': {'tflint': ['terraform_required_version'],
               'tfsec': [],
               'checkov': ['CKV_AWS_116', 'CKV_AWS_117'],
               'trivy': ['DS014', 'DS026']},
 'cloudformation': {'cfn_lint': [], 'cfn_nag': ['W89'], 'checkov': ['CKV_AWS_116', 'CKV_AWS_117']},
 'python': {'bandit': ['B404', 'B603', 'B110', 'B112'],
            'safety': [],
            'pylint': ['C0301', 'R0913', 'R0914', 'R0917 ']},
 'npm': {'snyk': []},
 'secrets': {'gitleaks': ['generic-api-key']},
 'container': {'trivy': []}}
# ---------------------------------------------------------------------------------------------
